"""The stages one after the other, each against what its contract says of its own input."""

import corpus_pipeline
from eventrank.llm import decontaminate, linededup, neardup, quality
from eventrank.llm.common import read
from eventrank.sources.session import stored

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs = read(spark, SF, "documents")
    results = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        results.append(docs)
    judged, lines, distinct, clean, packed = results
    assert {tuple(x.columns) for x in results[:-1]} == {("doc_id", "text", "lang", "source", "n_chars")}

    report = quality.report(read(spark, SF, "documents"), read(spark, SF, "labels"))
    assert ids(judged) == {r.doc_id for r in report.where("predicted = 1").collect()}

    removed = {r.doc_id: (r.removed, r.text) for r in linededup.deduplicated(judged).collect()}
    assert ids(lines) == {i for i, (gone, text) in removed.items() if not gone or text.strip()}
    assert all(r.text == removed[r.doc_id][1] and r.n_chars == len(r.text) for r in lines.collect())

    groups = neardup.groups(lines, 80, 5).collect()
    assert ids(distinct) == {r.component_id for r in groups}

    report = decontaminate.report(distinct, read(spark, SF, "benchmark")).collect()
    assert ids(clean) == {r.doc_id for r in report if not r.contaminated}

    assert ids(packed) == ids(clean)
    used = {}
    for r in packed.collect():
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert max(sum(n for _, n in x) for x in used.values()) <= 1024

    whole = corpus_pipeline.run(spark, SF)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(*columns).collect())) == sorted(map(tuple, packed.select(*columns).collect()))


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}
