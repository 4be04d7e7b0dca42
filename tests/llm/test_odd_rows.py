"""Nulls, empty and very long texts, ties, repeated rows, empty tables and columns with clashing names, by operator."""

import corpus_pipeline
import public_tokenizers
import pytest

from eventrank.llm import decontaminate, language, linededup, neardup, packing, pii, quality, rules, secrets, unitdedup
from tests.llm import data

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
N = len(data.odd_rows())


def bench(spark):
    text = " ".join(data.words(3, 20))
    return data.benchmark(spark, [(1, data.prose(13, 60)), (1, data.prose(13, 60)), (2, None), (None, text), (3, ""), (4, "one")])


def by_id(rows):
    out = {}
    for r in rows:
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_decontamination(spark):
    found = by_id(decontaminate.report(data.odd(spark), bench(spark)).collect())
    assert sum(map(len, found.values())) == N
    assert [r["n_hit"] for r in found[5] + found[6]] == [60] * 3
    assert found[9][0]["n_hit"] == 1 and found[9][0]["contaminated"]
    assert [r["n_words"] for r in found[2] + found[3] + found[4]] == [0, 0, 0]
    assert not found[2][0]["contaminated"] and len(found[None]) == 2


def test_decontamination_in_blocks_is_the_same(spark):
    docs, items = data.odd(spark), bench(spark)
    whole = decontaminate.contamination(docs, items).collect()
    cut = decontaminate.contamination(docs, items, block_windows=7).collect()
    plain = lambda rows: sorted((str(r["doc_id"]), r["text_key"] or 0, r["n_words"], str(r["hits"]), sorted(r["items"])) for r in rows)
    assert plain(whole) == plain(cut)


def test_packing(spark):
    rows = packing.pack(data.odd(spark), TOKENIZER, shard=8).collect()
    assert sum(r["piece"] == 0 for r in rows) == N
    filled = {}
    for r in rows:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert {r["length"] for r in rows if r["doc_id"] in (2, 3)} == {1}


def test_personal_data(spark):
    more = [(20, "mail a.b@c.de or 10.0.0.1"), (21, "4111 1111 1111 1111"), (22, "9" * 100_000 + "." * 50_000 + "a" * 100_000 + "@")]
    docs = data.frame(spark, [(r[0], r[1]) for r in data.odd_rows()] + more)
    found = by_id(pii.report(docs).collect())
    assert found[20][0]["spans"] == "email:5:13,ip:17:25" and found[21][0]["n_card"] == 1
    assert found[2][0]["spans"] == "" and len(found[None]) == 2 and found[22][0]["n_card"] == 0


def test_secrets(spark):
    rows = [(r[0], r[1]) for r in data.odd_rows()] + [(20, 'x token = "0a1b2c3d4e5f60718293" y 1234567890123456'), (20, None)]
    found = by_id(secrets.report(data.frame(spark, rows)).collect())
    assert [(r["start"], r["end"], r["is_secret"]) for r in sorted(found[20], key=lambda r: r["start"])] == [(11, 31, True), (35, 51, False)]
    assert secrets.report(data.odd(spark)).where("secret IS NULL").count() == 0


def test_language(spark):
    found = by_id(language.identified(data.odd(spark)).collect())
    assert sum(map(len, found.values())) == N
    assert {r["lang_pred"] for i in (2, 3, 4, 12) for r in found[i]} == {"und"}
    assert found[1][0]["lang_pred"] == "xx"
    assert all(0 <= r["score"] <= 1 for x in found.values() for r in x)


def test_substring_dedup(spark):
    found = unitdedup.passages(data.odd(spark)).collect()
    assert {r["doc_id"] for r in found} == {6, 11}  # repetitions within a text count, too
    short = unitdedup.passages(data.frame(spark, [(1, "One of ten words in all. " * 2), (2, "One of ten words in all.")])).collect()
    assert short == [] and unitdedup.passages(data.frame(spark, [(i, data.prose(13, 30)) for i in (1, 2)])).count() > 0
    kept = by_id(unitdedup.deduplicated(data.odd(spark)).collect())
    assert sum(map(len, kept.values())) == N
    assert kept[6][0]["text"] == "" and kept[5][0]["text"] == data.prose(13, 60) and kept[2][0]["text"] is None
    assert kept[7][0]["text"] == data.prose(1, 30_000)


def test_near_duplicates(spark):
    found = by_id(neardup.report(data.odd(spark)).collect())
    assert sum(map(len, found.values())) == N
    assert [(r["component_id"], r["kept"]) for r in found[5] + found[6]] == [(5, True), (5, True), (5, False)]
    assert all(r["kept"] and r["n_shingles"] == 0 for i in (2, 3, 4) for r in found[i])
    assert all(r["component_id"] is None and r["kept"] for r in found[None])
    kept = neardup.deduplicated(data.odd(spark), 80, 5)
    assert kept.columns == data.odd(spark).columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] in (5, 6)) == [5]


def test_line_dedup(spark):
    docs = data.odd(spark)
    rows = linededup.deduplicated(docs)
    found = by_id(rows.collect())
    assert sum(map(len, found.values())) == N and set(rows.columns) == set(docs.columns)
    assert found[11][0]["text"] == "a\n" and found[2][0]["text"] is None and found[2][0]["n_lines"] == 0
    assert found[5][0]["text"] == found[5][1]["text"] == data.prose(13, 60)
    assert found[6][0]["text"] == ""


def test_quality(spark):
    good = [(100 + i, data.prose(200 + i, 60)) for i in range(40)]
    bad = [(300 + i, " | ".join(data.words(400 + i, 40)) + " $$$") for i in range(40)]
    known = data.labels(spark, [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(1, 1, 0), (1, 0, 0), (None, 1, 0), (5, None, 0)])
    docs = data.frame(spark, [(r[0], r[1]) for r in data.odd_rows()] + good + bad)
    found = by_id(quality.report(docs, known).collect())
    assert sum(map(len, found.values())) == N + 80
    assert all(found[i][0]["predicted"] == 1 for i, _ in good) and all(found[i][0]["predicted"] == 0 for i, _ in bad)
    assert {found[i][0]["score"] for i in (2, 3, 4)} == {0.5} and all(r["held_out"] for r in found[None])
    kept = quality.accepted(docs, known)
    assert kept.columns == docs.columns and kept.where("doc_id >= 300 AND doc_id < 400").count() == 0


def test_quality_rules(spark):
    found = by_id(rules.report(data.odd(spark)).collect())
    assert sum(map(len, found.values())) == N
    assert all(r["base_failed"] and not r["kept"] for i in (2, 3, 4, 9, 11) for r in found[i])
    assert found[11][0]["n_dup_lines"] == 399 and found[1][0]["kept"]


@pytest.mark.parametrize("operator", [
    lambda d, b, k: decontaminate.report(d, b), lambda d, b, k: decontaminate.decontaminated(d, b),
    lambda d, b, k: packing.pack(d, TOKENIZER), lambda d, b, k: pii.report(d), lambda d, b, k: secrets.report(d),
    lambda d, b, k: language.identified(d), lambda d, b, k: unitdedup.report(d), lambda d, b, k: neardup.report(d),
    lambda d, b, k: neardup.deduplicated(d, 80, 5), lambda d, b, k: linededup.report(d), lambda d, b, k: quality.report(d, k),
    lambda d, b, k: rules.report(d), lambda d, b, k: quality.accepted(d, k), lambda d, b, k: linededup.deduplicated(d),
    lambda d, b, k: unitdedup.deduplicated(d),
])
def test_empty_tables(spark, operator):
    empty = data.odd(spark).limit(0)
    items, known = data.benchmark(spark, []), data.labels(spark, [])
    assert operator(empty, items, known).collect() == []
    some = data.frame(spark, [(1, "one"), (2, None)])
    operator(some, items, known).collect()


def test_stages_keep_the_columns_of_documents(spark, folder):
    docs = data.odd(spark)
    data.labels(spark, [(i, 1, 0) for i in range(100, 140)]).write.parquet(f"{folder}/labels.parquet")
    bench(spark).write.parquet(f"{folder}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def stored_tables(docs, known, items, folder):
    for name, df in (("documents", docs), ("labels", known), ("benchmark", items)):
        df.write.parquet(f"{folder}/{name}.parquet")


def test_stages_keep_the_right_odd_rows(spark, folder):
    docs = data.odd(spark)
    stored_tables(docs, data.labels(spark, [(i, 1, 0) for i in range(100, 140)]), bench(spark), folder)
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in df.collect())
    every = ids(docs)
    # Nothing was learnt, so nothing is accepted.
    assert ids(stages["quality"](spark, docs, folder)) == []
    # The later copy has lost all its lines; texts that never had one stay.
    assert ids(stages["line_dedup"](spark, docs, folder)) == [x for x in every if x != (False, 6)]
    # Of repeated rows one stays, and nothing else is like anything.
    left = [x for x in every if x != (False, 6)]
    left.remove((False, 5))
    assert ids(stages["near_dedup"](spark, docs, folder)) == left
    # Item 4 is the word of document 9, item 1 the text of 5 and 6.
    assert ids(stages["decontamination"](spark, docs, folder)) == [x for x in every if x[1] not in (5, 6, 9) or x[0]]


def test_run_on_odd_rows(spark, folder):
    good = [(100 + i, data.prose(200 + i, 60)) for i in range(40)]
    bad = [(300 + i, " | ".join(data.words(400 + i, 40)) + " $$$") for i in range(40)]
    docs = data.frame(spark, [(r[0], r[1]) for r in data.odd_rows()] + good + good[:3] + bad + [(500, None), (501, good[0][1])])
    known = data.labels(spark, [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad])
    stored_tables(docs, known, data.benchmark(spark, [(1, None), (2, good[5][1])]), folder)
    rows = corpus_pipeline.run(spark, folder).collect()
    found = {r["doc_id"] for r in rows}
    # Copies and the item's document are gone, others of the good ones stay, once each.
    assert {i for i, _ in good} - {105} <= found and not found & ({105, 501} | {i for i, _ in bad})
    assert all(sum(r["doc_id"] == i and r["piece"] == 0 for r in rows) == 1 for i in found)


def test_run_on_empty_tables(spark, folder):
    stored_tables(data.frame(spark, []), data.labels(spark, []), data.benchmark(spark, []), folder)
    assert corpus_pipeline.run(spark, folder).collect() == []
