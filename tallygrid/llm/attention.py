"""A small causal self-attention model over subword ids, trained and run in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Ids of a context window, and those of its start that only give context (they were scored in the window before).
WINDOW, OVERLAP = 48, 12
#: Width of the model, and the two levels of its output: GROUPS groups of GROUPS ids.
WIDTH, GROUPS = 16, 64
#: Id of the start of a text, of its end, and of all beginnings without an id of their own.
START, END, RARE, FIRST = 0, 1, 2, 3
IDS = GROUPS * GROUPS
#: Rows of logits that are turned into chances at once.
ROWS = 1024
#: Subwords with an id: common words whole, and three-byte beginnings of the other words.
BEGINNINGS = 1024
COMMON = IDS - FIRST - BEGINNINGS


def beginnings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first three bytes of each word, zeros behind shorter ones. ``data`` goes on for two bytes behind the last word."""
    size = ends - starts
    out = data[starts].astype(np.int64) << 16
    out |= np.where(size > 1, data[starts + 1], 0).astype(np.int64) << 8
    return out | np.where(size > 2, data[starts + 2], 0)


@dataclass
class Vocabulary:
    """Ids of common words and of other words' beginnings, and the chances of the rests of words.

    A word that isn't common is two subwords: its beginning, which has an id
    (RARE if it has none of its own), and its rest, whose chance is the word's
    share of the training words of that id, by ``totals``. Words that never
    occur share ``unseen`` of it, as many as occur once and one more, and are spelled:
    ``spelling`` has the log chance of a byte behind another, 0 being the end.
    """

    words: np.ndarray  # sorted hashes
    word_ids: np.ndarray
    begins: np.ndarray  # sorted
    begin_ids: np.ndarray
    counts: np.ndarray  # by id
    totals: np.ndarray  # by id, the unseen with it
    unseen: np.ndarray  # by id
    discount: float
    spelling: tuple[np.ndarray, np.ndarray]

    @staticmethod
    def of(words: list[tuple[int, int]], begins: list[tuple[int, int, int]], rest: tuple[int, int], ends: int, discount: float, spelling: tuple[np.ndarray, np.ndarray]) -> Vocabulary:
        """From (hash, n) of common words and (beginning, n, kinds) of others, both by falling n, and n and kinds of words with further beginnings."""
        counts, totals, unseen = np.zeros(IDS), np.ones(IDS), np.ones(IDS)
        counts[END] = ends
        at = FIRST
        for i, n, kinds in [(RARE, *rest), *((at + k, n, kinds) for k, (_, n, kinds) in enumerate(begins))]:
            counts[i], unseen[i], totals[i] = n, discount * kinds + 1, n + 1
        at += len(begins)
        counts[at : at + len(words)] = [n for _, n in words]
        # Ids of a group are alike in frequency.
        rank = np.arange(IDS)
        rank[FIRST:] = FIRST + np.argsort(np.argsort(-counts[FIRST:], kind="stable"), kind="stable")
        moved = lambda x: x[np.argsort(rank)]
        word, begin = np.array([w for w, _ in words], dtype=np.int64), np.array([b for b, *_ in begins], dtype=np.int64)
        by_word, by_begin = np.argsort(word), np.argsort(begin)
        own = word[by_word], rank[at + by_word], begin[by_begin], rank[FIRST + by_begin]
        return Vocabulary(*own, moved(counts), moved(totals), moved(unseen), discount, spelling)

    def encode(self, hashes: np.ndarray, starts_with: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The id of each word, and the places of those that aren't common."""
        ids = np.full(len(hashes), RARE, dtype=np.int64)
        common = np.zeros(len(hashes), dtype=bool)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            common = self.words[at] == hashes
            ids[common] = self.word_ids[at[common]]
        others = np.flatnonzero(~common)
        if len(self.begins):
            wanted = starts_with[others]
            at = np.minimum(np.searchsorted(self.begins, wanted), len(self.begins) - 1)
            hit = self.begins[at] == wanted
            ids[others[hit]] = self.begin_ids[at[hit]]
        return ids, others


def windows(begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per window of any text: where its first target is, how many targets, and how many ids before them are context."""
    step = WINDOW - OVERLAP
    sizes = np.diff(begins)
    per_text = np.maximum(1, -(-(sizes - OVERLAP) // step))
    text = np.repeat(np.arange(len(sizes)), per_text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    # The first window has all its WINDOW targets, the others those behind the overlap.
    first = np.where(number == 0, 0, WINDOW + (number - 1) * step)
    stop = np.minimum(WINDOW + number * step, sizes[text])
    keep = (stop > first) & (sizes[text] > 0)
    return begins[text][keep] + first[keep], (stop - first)[keep], np.where(number == 0, 0, OVERLAP)[keep]


@dataclass
class Attention:
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(counts: np.ndarray, seed: int = 5) -> Attention:
        rng = np.random.default_rng(seed)
        d, scale = WIDTH, 0.3 / np.sqrt(WIDTH)
        shares = np.log(counts + 0.5).reshape(GROUPS, GROUPS)
        w = {
            "embed": rng.normal(0, 0.3, (IDS, d)),
            "place": rng.normal(0, 0.05, (WINDOW, d)),
            "qkv": rng.normal(0, scale, (d, 3 * d)),
            "out": rng.normal(0, scale, (d, d)),
            "up": rng.normal(0, scale, (d, 3 * d)),
            "up_bias": np.zeros(3 * d),
            "down": rng.normal(0, scale / 2, (3 * d, d)),
            "group": rng.normal(0, 0.05, (d, GROUPS)),
            "group_bias": np.log(np.exp(shares).sum(axis=1)),
            "member": rng.normal(0, 0.05, (GROUPS, d, GROUPS)),
            "member_bias": shares,
        }
        return Attention({k: v.astype(np.float32) for k, v in w.items()})

    def flat(self) -> np.ndarray:
        """All weights in a row."""
        return np.concatenate([self.weights[k].ravel() for k in sorted(self.weights)])

    def moved(self, by: np.ndarray) -> Attention:
        """A copy with ``by`` added to its weights in a row."""
        out, at = {}, 0
        for k in sorted(self.weights):
            w = self.weights[k]
            out[k] = w + by[at : at + w.size].reshape(w.shape).astype(w.dtype)
            at += w.size
        return Attention(out)

    def attended(self, x: np.ndarray, n: int, t: int) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        """What each place of ``n`` windows sees up to itself, and for the gradients queries, keys, values, weights and
        what they are multiplied with: weights stay without their sums, which come with the values in one product."""
        qkv = (x @ self.weights["qkv"]).reshape(n, t, 3 * WIDTH)
        q = qkv[:, :, :WIDTH] * x.dtype.type(WIDTH**-0.5)
        k = np.ascontiguousarray(qkv[:, :, WIDTH : 2 * WIDTH])
        v = np.ones((n, t, WIDTH + 1), dtype=x.dtype)
        v[:, :, :WIDTH] = qkv[:, :, 2 * WIDTH :]
        before = np.tril(np.ones((t, t), dtype=x.dtype))
        a = _exp(np.matmul(q, k.transpose(0, 2, 1)), before)
        a *= before
        seen = np.matmul(a, v).reshape(-1, WIDTH + 1)
        share = 1 / seen[:, WIDTH:]
        return seen[:, :WIDTH] * share, (q, k, v, a, share)

    def hidden(self, ids: np.ndarray) -> tuple[np.ndarray, dict]:
        """States of a batch of windows; place t sees the places up to t only."""
        w, (n, t) = self.weights, ids.shape
        x = (w["embed"].take(ids.ravel(), axis=0).reshape(n, t, WIDTH) + w["place"][:t]).reshape(-1, WIDTH)
        seen, parts = self.attended(x, n, t)
        y = x + seen @ w["out"]
        active = y @ w["up"]
        active += w["up_bias"]
        np.maximum(active, 0, out=active)
        z = y + active @ w["down"]
        return z.reshape(n, t, WIDTH), {"x": x, "parts": parts, "seen": seen, "y": y, "active": active}

    def by_group(self, z: np.ndarray, targets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """Those rows of the states, each with a one for the biases, and their targets, sorted by the target's group; logits
        of the groups and of the members of the target's group; the order, and where groups begin."""
        w, goal = self.weights, targets.ravel()[rows]
        order = np.argsort((goal // GROUPS).astype(np.uint8), kind="stable")
        goal = goal[order]
        zs = np.ones((len(rows), WIDTH + 1), dtype=z.dtype)
        zs[:, :WIDTH] = z.take(rows[order], axis=0)
        top = zs @ np.concatenate([w["group"], w["group_bias"][None]])
        members = np.concatenate([w["member"], w["member_bias"][:, None]], axis=1)
        low = np.empty_like(top)
        cuts = np.searchsorted(goal // GROUPS, np.arange(GROUPS + 1)).tolist()
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if a < b:
                np.matmul(zs[a:b], members[i], out=low[a:b])
        return zs, goal, top, low, order, cuts

    def log_chances(self, z: np.ndarray, targets: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """Log chance of each target id, of all rows or of some, given the states before them."""
        _, goal, top, low, order, _ = self.by_group(z, targets, np.arange(len(z)) if rows is None else rows)
        ones, sums = np.ones(GROUPS, dtype=z.dtype), np.zeros(len(goal), dtype=z.dtype)
        for x, at in ((top, goal // GROUPS), (low, goal % GROUPS)):
            for a in range(0, len(goal), ROWS):
                part = x[a : a + ROWS]
                np.clip(part, -40, 40, out=part)  # no overflow, and the chances still sum to one
                sums[a : a + ROWS] += part[np.arange(len(part)), at[a : a + ROWS]] - np.log(np.exp(part, out=part) @ ones)
        out = np.empty(len(order))
        out[order] = sums
        return out

    def states(self, ids: np.ndarray) -> np.ndarray:
        """As hidden, a row a place, without what training needs."""
        return self.hidden(ids)[0].reshape(-1, WIDTH)

    def step(self, ids: np.ndarray, targets: np.ndarray, used: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss over the used targets, and its gradients."""
        w = self.weights
        z, c = self.hidden(ids)
        n, t = ids.shape
        flat = z.reshape(-1, WIDTH)
        rows = np.flatnonzero(used.ravel())
        zs, goal, top, low, order, cuts = self.by_group(flat, targets, rows)
        m, loss = len(rows), 0.0
        for x, at in ((top, goal // GROUPS), (low, goal % GROUPS)):
            for a in range(0, m, ROWS):
                loss += _lost(x[a : a + ROWS], at[a : a + ROWS], m)
        g = {}

        both = zs.T @ top
        g["group"], g["group_bias"] = both[:WIDTH], both[WIDTH]
        both, dz = np.zeros((GROUPS, WIDTH + 1, GROUPS), dtype=flat.dtype), np.empty((m, WIDTH), dtype=flat.dtype)
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if a < b:
                np.matmul(zs[a:b].T, low[a:b], out=both[i])
                np.matmul(low[a:b], w["member"][i].T, out=dz[a:b])
        g["member"], g["member_bias"] = both[:, :WIDTH], both[:, WIDTH]
        dz += top @ w["group"].T
        d = np.zeros_like(flat)
        d[rows[order]] = dz
        ones, active = np.ones(n * t, dtype=flat.dtype), c["active"]
        g["down"] = active.T @ d
        du = d @ w["down"].T
        du *= active > 0
        g["up"], g["up_bias"] = c["y"].T @ du, ones @ du
        dy = d + du @ w["up"].T
        g["out"] = c["seen"].T @ dy
        q, k, v, a, share = c["parts"]
        ds = np.empty((n * t, WIDTH + 1), dtype=flat.dtype)  # what a weight gains, less what all of its place gain on average
        np.multiply(dy @ w["out"].T, share, out=ds[:, :WIDTH])
        ds[:, WIDTH] = -np.einsum("ij,ij->i", ds[:, :WIDTH], c["seen"])
        ds = ds.reshape(n, t, WIDTH + 1)
        da = np.matmul(ds, v.transpose(0, 2, 1))
        da *= a
        dqkv = np.empty((n, t, 3 * WIDTH), dtype=flat.dtype)
        np.multiply(np.matmul(da, k), flat.dtype.type(WIDTH**-0.5), out=dqkv[:, :, :WIDTH])
        dqkv[:, :, WIDTH : 2 * WIDTH] = np.matmul(da.transpose(0, 2, 1), q)
        dqkv[:, :, 2 * WIDTH :] = np.matmul(a.transpose(0, 2, 1), ds[:, :, :WIDTH])
        dqkv = dqkv.reshape(n * t, 3 * WIDTH)
        g["qkv"] = c["x"].T @ dqkv
        dx = dy + dqkv @ w["qkv"].T
        places = (ids.ravel()[:, None] * WIDTH + np.arange(WIDTH)).ravel()
        g["embed"] = np.bincount(places, dx.ravel(), IDS * WIDTH).reshape(IDS, WIDTH).astype(flat.dtype)
        g["place"] = np.zeros_like(w["place"])
        g["place"][:t] = (ones[:n] @ dx.reshape(n, t * WIDTH)).reshape(t, WIDTH)
        return float(loss), g

    def score(self, ids: np.ndarray, begins: np.ndarray, batch: int = 256) -> np.ndarray:
        """Log chance of every id, each scored once."""
        firsts, sizes, context = windows(begins)
        out = np.zeros(len(ids))
        for a in range(0, len(firsts), batch):
            part = slice(a, a + batch)
            x, y, used = window_arrays(ids, firsts[part], sizes[part], context[part])
            rows = np.flatnonzero(used.ravel())
            place = np.repeat(firsts[part], sizes[part]) + _counter(sizes[part])
            z = np.concatenate([self.states(x[b : b + 64]) for b in range(0, len(x), 64)])  # what 64 windows take stays near the processor
            out[place] = self.log_chances(z, y, rows)
        return out


class Trainer:
    """Adam over the windows of texts as they come, on a copy of a model; ``windows`` counts those used."""

    def __init__(self, start: Attention, rate: float, seed: int = 11) -> None:
        self.model, self.rate, self.rng = start.moved(np.zeros(len(start.flat()))), rate, np.random.default_rng(seed)
        self.mean, self.square = np.zeros((2, len(start.flat())), dtype=start.weights["embed"].dtype)
        self.steps = self.windows = 0

    def learn(self, ids: np.ndarray, begins: np.ndarray, share: int, shares: int, batch: int) -> None:
        """Every window whose number is ``share`` modulo ``shares``."""
        firsts, sizes, context = (x[share::shares] for x in windows(begins))
        self.windows += len(firsts)
        order = self.rng.permutation(len(firsts))
        for a in range(0, len(order), batch):
            chosen = order[a : a + batch]
            self._step(*window_arrays(ids, firsts[chosen], sizes[chosen], context[chosen]))

    def _step(self, x: np.ndarray, y: np.ndarray, used: np.ndarray) -> None:
        _, found = self.model.step(x, y, used)
        self.steps += 1
        i = self.steps
        now = self.rate * min(1.0, i / 30)
        first, second = 1 - 0.9**i, 1 - 0.99**i
        names = sorted(found)
        g = np.concatenate([found[k].ravel() for k in names])
        self.mean += 0.1 * (g - self.mean)
        g *= g
        g -= self.square
        g *= 0.01
        self.square += g
        by = np.sqrt(self.square / second)
        by += 1e-8
        np.divide(self.mean * (now / first), by, out=by)
        at = 0
        for k in names:
            v = self.model.weights[k]
            v -= by[at : at + v.size].reshape(v.shape)
            at += v.size


def _counter(sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def window_arrays(ids: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets and which targets count: a target's input is the id before it, START for a text's first."""
    t = int((sizes + context).max())
    places = (firsts - context)[:, None] + np.arange(t)
    y = ids[np.clip(places, 0, len(ids) - 1)]
    x = ids[np.clip(places - 1, 0, len(ids) - 1)]
    x[context == 0, 0] = START
    at = np.arange(t)
    return x, y, (at >= context[:, None]) & (at < (context + sizes)[:, None])


def _lost(x: np.ndarray, at: np.ndarray, m: int) -> float:
    """The loss of some of ``m`` rows of logits, as a share of the mean; the logits become its gradient."""
    _exp(x)
    x *= 1 / (m * (x @ np.ones(x.shape[1], dtype=x.dtype))[:, None])
    own = np.arange(len(at)), at
    chances = x[own] * m
    x[own] -= 1 / m
    return -np.log(chances + 1e-30).sum() / m


def _exp(x: np.ndarray, kept: np.ndarray | None = None) -> np.ndarray:
    """exp in place. Only where values are too large or too small for that, rows are moved first, to a largest of 0 among those ``kept``."""
    if max(x.max(initial=0), -x.min(initial=0)) > 40:
        x -= (x if kept is None else np.where(kept > 0, x, -np.inf)).max(axis=-1, keepdims=True)
        np.minimum(x, 0, out=x)
    return np.exp(x, out=x)
