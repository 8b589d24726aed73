import corpus_pipeline
import pytest

from tallygrid.llm import entry
import llm_brute as brute

OPERATORS = [name for name in entry.QUERIES if name.startswith("op")]


def test_registered():
    assert sorted({int(n[2:].split("_")[0]) for n in OPERATORS}) == list(range(1, 14)) and "pipeline" in entry.QUERIES


@pytest.fixture(scope="module")
def empty_tables(spark, small, tmp_path_factory):
    root = tmp_path_factory.mktemp("empty")
    for name in ("documents", "embeddings", "labels"):
        spark.read.parquet(f"{small}/{name}.parquet").where("false").write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.mark.parametrize("name", [*OPERATORS, "pipeline"])
def test_empty_tables(spark, empty_tables, name):
    assert entry.QUERIES[name](spark, empty_tables).count() == 0


def test_pipeline_stages_on_awkward_rows(spark, docs_of, awkward):
    docs = docs_of(awkward)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == len(awkward)


def test_pipeline_against_plain_stages(spark, small):
    rows = {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    folder = spark.read.parquet(f"{small}/documents.parquet")
    good = {r.doc_id for r in corpus_pipeline.quality_rules(spark, folder, small).collect()}
    assert all(not brute.quality_counts(rows[i].text)[-1] for i in good)
    one = set(brute.components([(i, rows[i].text) for i in sorted(good)], 5, 80).values())
    flags = dict(zip(sorted(one), brute.covered([rows[i].text for i in sorted(one)], 400), strict=True))
    left = {i for i in one if not all(flags[i]) or not rows[i].text}
    docs, seen = folder, []
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, small)
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert seen == [good, one, left]
    result = corpus_pipeline.run(spark, small)
    assert {r.doc_id for r in result.select("doc_id").collect()} <= left and result.count() >= len(left)


def test_a_worker_gives_back_its_memory_after_a_task():
    import re
    from pathlib import Path

    import numpy as np

    from tallygrid.llm import repeats
    from tallygrid.llm.common import freed

    class Docs:
        def mapInPandas(self, work, schema):  # noqa: N802
            return work

    def held():
        return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024

    last = []

    def work(frames):
        for n in frames:
            own = [np.ones(6000) for _ in range(n)]
            last.append(np.ones(6000))  # lies behind the others, so these don't go by themselves
            yield held()
            del own

    before = held()
    most = max(freed(work)([4000]))
    assert most - before > 150
    assert held() - before < 50
    assert repeats._fragments(Docs(), repeats.LENGTH).__wrapped__


def test_a_codec_forgets_many_stretches_after_a_task(monkeypatch):
    from tallygrid.llm import spm

    codec = spm.Codec.__new__(spm.Codec)
    codec.known = {str(i): b"" for i in range(100)}
    codec.rest()
    assert len(codec.known) == 100
    monkeypatch.setattr(spm, "KEPT", 99)
    codec.rest()
    assert not codec.known
