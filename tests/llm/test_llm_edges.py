"""Every operator and stage on odd rows: NULLs, empty and long texts, repeats, extra columns, no rows."""

import random

import pytest

import corpus_pipeline
from lakewarden.llm import (
    decontamination,
    language_model,
    licenses,
    mixing,
    quality_model,
    quality_rules,
    secrets,
    sharding,
    simhash,
    token_counts,
)

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "score double, size long, shard string, kept string, word string, id string, cell string, _t string"
)
EXTRA = (0.5, 7, "s", "k", "w", "i", "c", "t")


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(n))


def rows():
    long = prose(1, 40_000)
    texts = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, long), (6, prose(2, 60)), (7, prose(2, 60)),
        (8, "\x01\x01 x"), (9, "É" * 5000), (None, prose(3, 50)), (10, prose(4, 40)), (10, prose(4, 40)),
        (10, prose(5, 30)), (None, None), (11, 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end'),
        (12, "All rights reserved."),
    ]
    out = []
    for i, (doc, text) in enumerate(texts):
        lang = None if i % 5 == 0 else "en"
        source = None if i % 4 == 0 else f"src{i % 3}"
        out.append((doc, text, lang, source, None if i % 3 else 5, *EXTRA))
    return out


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(
        [(4, 0, 0), (5, 1, 0), (6, 1, 0), (None, 1, None), (7, None, 1), (10, 1, 0), (10, 0, 0)],
        "doc_id long, quality int, toxic int",
    ).write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame(
        [(1, prose(6, 20)), (2, None), (3, ""), (None, "nothing like it at all in any of these texts")],
        "item_id long, text string",
    ).write.parquet(f"{at}/benchmark.parquet")
    return str(at)


PER_ROW = {
    "simhash": lambda d, s, f: simhash.near_duplicates(d),
    "shards": lambda d, s, f: sharding.shard_documents(d, 4),
    "mix": lambda d, s, f: mixing.mix_documents(d),
    "quality": lambda d, s, f: quality_model.score_documents(d, s.read.parquet(f"{f}/labels.parquet")),
    "rules": lambda d, s, f: quality_rules.judge(d),
    "model": lambda d, s, f: language_model.score_documents(d, rounds=1, draws=4000, trainers=2),
}
OTHERS = {
    "secrets": lambda d, s, f: secrets.scan(d),
    "licenses": lambda d, s, f: licenses.scan(d),
    "counts": lambda d, s, f: token_counts.length_totals(d),
    "leaks": lambda d, s, f: decontamination.find_leaks(d, s.read.parquet(f"{f}/benchmark.parquet")),
}


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_one_row_per_row(spark, odd, folder, name):
    got = PER_ROW[name](odd, spark, folder)
    ids = sorted((r["doc_id"] for r in got.collect()), key=lambda x: (x is None, x))
    assert ids == sorted((r[0] for r in rows()), key=lambda x: (x is None, x))


@pytest.mark.parametrize("name", sorted(PER_ROW | OTHERS))
def test_no_rows(spark, none, folder, name):
    assert (PER_ROW | OTHERS)[name](none, spark, folder).collect() == []


@pytest.mark.parametrize("name", sorted(OTHERS))
def test_others_run(spark, odd, folder, name):
    got = OTHERS[name](odd, spark, folder).collect()
    if name == "secrets":
        assert [(r.doc_id, r.is_secret) for r in got] == [(11, True)]
    if name == "licenses":
        assert [(r.doc_id, r.license, r.start_char, r.end_char) for r in got] == [(12, "All rights reserved", 0, 20)]
    if name == "counts":
        assert sum(r.n_docs for r in got if r.scope == "all") == len(rows())


@pytest.mark.parametrize("stage", range(5))
def test_stages(spark, odd, none, folder, stage):
    fn = corpus_pipeline.STAGES[stage][1]
    empty = fn(spark, none, folder)
    assert empty.collect() == []
    got = fn(spark, odd, folder)
    if stage < 4:
        assert got.columns == odd.columns == empty.columns
    assert {tuple(r)[5:13] for r in got.collect()} <= {EXTRA}


def test_simhash_edges(odd):
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(odd).collect()}
    assert {c for (d, f), c in got.items() if f == "0" * 16} == {1}
    assert len({f for (d, f) in got if d in (6, 7)}) == 1 and {c for (d, f), c in got.items() if d == 7} == {6}
    kept = sorted(r.doc_id for r in simhash.keep_one(odd).filter("doc_id IS NOT NULL").collect())
    assert 7 not in kept and 2 not in kept and kept.count(10) == 2  # two different texts have the id 10


def test_shard_edges(odd):
    got = sharding.shard_documents(odd, 4).collect()
    for s in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert {r.size for r in got if r.doc_id in (1, 2)} == {16}


def test_mix_edges(odd):
    got = mixing.mix_documents(odd).collect()
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert {r.size for r in got if r.doc_id in (1, 2, 3)} == {0}
    again = mixing.mix_documents(odd.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_rules_edges(odd):
    got = {r.doc_id: r for r in quality_rules.judge(odd).collect()}
    assert not got[1].kept and got[1].base_failed and got[1].n_words == 0
    assert got[9].word_chars == 5000 and got[5].n_words == 40_000
