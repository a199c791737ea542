"""The Merkle manifest, the filter audit and the toxicity scores, against brute force and on odd rows."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from lakewarden.llm import filter_audit, merkle, toxicity

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, tree string, pos long, digest string, "
    "n long, mask int, id long, part string, label int, score double, path string"
)
EXTRA = ("t", 1, "d", 2, 3, 4, "p", 5, 0.5, "x")


def odd_rows():
    texts = [
        (1, None), (2, ""), (3, "  \n\t"), (4, "one"), (5, "Word word É " * 20_000), (6, "A B C"), (7, "A B C"),
        (8, "\x01 |"), (None, "A B C"), (10, "same"), (10, "same"), (10, "other"), (None, None), (11, ""), (12, "İ Σ ß AZ"),
        (-3, "below"), (13, "x" * 300_000),
    ]
    out = []
    for i, (doc, text) in enumerate(texts):
        lang = [None, "en", "", "é", "-"][i % 5]
        out.append((doc, text, lang, None if i % 4 == 0 else f"s{i % 3}", None if i % 3 else 5, *EXTRA))
    return out + [out[9]]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(4, 0, 0), (5, 1, 0), (6, 1, 1), (7, 1, 0), (None, 1, 1), (10, 0, None), (10, 1, 0), (11, None, 1), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").cache()


# --- the manifest ---------------------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(leaves, fanout):
    rows = [leaves]
    while len(rows[-1]) > 1:
        rows.append([sha(*rows[-1][i : i + fanout]) for i in range(0, len(rows[-1]), fanout)])
    return rows


def slow_manifest(rows, fanout=8):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of dicts, by whole trees in memory."""
    trees = {}
    for r in rows:
        values = [r["doc_id"], r["source"], r["lang"], r["n_chars"]]
        leaf = sha(*map(encoded, [*values, r["text"]]))
        claimed = leaf
        if zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
            claimed = sha(*map(encoded, [*values, low]))
        trees.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf, claimed))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    own = {x: levels_of([leaf for _, _, leaf, _ in sorted(trees[x])], fanout) for x in langs}
    top = levels_of([own[x][-1][0] for x in langs], fanout)
    out = []
    for at, lang in enumerate(langs):
        for i, (known, doc, leaf, folded) in enumerate(sorted(trees[lang])):
            proof = ""
            for rows_up, j in ((own[lang], i), (top, at)):
                for row in rows_up[:-1]:
                    run, inside = row[j // fanout * fanout :][:fanout], j % fanout
                    proof += "".join(run[:inside] + run[inside + 1 :])
                    folded = sha(*run[:inside], folded, *run[inside + 1 :])
                    j //= fanout
            root = top[-1][0]
            out.append((doc if known else None, leaf, own[lang][-1][0], root, sha(proof), folded, folded == root))
    return out


def as_rows(df):
    names = "doc_id leaf subroot root proof_sha256 folded_root verified".split()
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest_of_documents(spark, levels):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    want = slow_manifest([r.asDict() for r in docs.collect()])
    assert as_rows(merkle.manifest(docs, levels=levels)) == sorted(want, key=str)
    assert {r[-1] for r in want} == {True, False}


@pytest.mark.parametrize("fanout", [2, 3, 8])
def test_manifest_of_odd_rows(spark, odd, none, fanout):
    rows = [dict(zip(["doc_id", "text", "lang", "source", "n_chars"], r)) for r in odd_rows()]
    assert as_rows(merkle.manifest(odd, fanout=fanout, levels=1)) == sorted(slow_manifest(rows, fanout), key=str)
    assert merkle.manifest(none).collect() == []


def test_manifest_of_one_hot_tree(spark):
    """A tree of many blocks and rounds beside trees of a few rows, each size around the borders of a block."""
    sizes = {"hot": 700, "a": 1, "b": 2, "c": 8, "d": 9, "e": 64, "f": 65, "g": 15, "h": 16, "i": 17}
    rows = [{"doc_id": i * 7 % 1009, "text": f"T{i}", "lang": x, "source": "s", "n_chars": i}
            for x, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert as_rows(merkle.manifest(df, fanout=8, levels=1)) == sorted(slow_manifest(rows), key=str)


def test_proofs_verify_and_tampering_shows(spark, odd):
    got = merkle.prove(odd, fanout=2, levels=1).collect()
    for r in got:
        path = [p.asDict() for p in r.path]
        assert merkle.proof_digest(path) == r.proof_sha256 and merkle.fold(r.leaf, path) == r.root
        assert merkle.fold(sha("another"), path) != r.root


# --- the filter audit -----------------------------------------------------------------------------------------


def slow_audit(docs, labels):
    """From (doc_id, text, lang) and {doc_id: (good, toxic)}: every order, step by step, over all documents."""
    texts = [(d, t or "", lang or "") for d, t, lang in docs]
    failed = []
    for doc, text, lang in texts:
        words = WORD.findall(text)
        f = ""
        f += "A" * (len(words) < 100)
        f += "B" * (100 * len(set(words)) < 80 * len(words))
        f += "C" * (100 * len(re.findall("[A-Z]", text)) > 10 * len(text))
        f += "D" * any(c in "#$%&*|" for c in text)
        f += "E" * (doc is not None and any(o is not None and o < doc and t == text for o, t, _ in texts))
        failed.append((lang, f, *labels.get(doc, (False, False))))
    out, shares = {}, {}
    for part in {x[0] for x in failed}:
        own = [x for x in failed if x[0] == part]
        for order in map("".join, itertools.permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shares[part, f] = shares.get((part, f), 0) + len(gone)
                out[part, order, step] = (
                    len(left), len(gone), sum(f in x[1] for x in own) - len(gone), sum(x[1] == f for x in own),
                    sum(x[2] for x in gone), sum(x[3] for x in gone),
                )
    return {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_rows(df):
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in filter_audit.COUNTS) for r in df.collect()}
    return got


def label_marks(labels):
    marks = {}
    for r in labels.collect():
        if r.doc_id is not None:
            good, toxic = marks.get(r.doc_id, (False, False))
            marks[r.doc_id] = (good or r.quality == 1, toxic or r.toxic == 1)
    return marks


def test_audit_of_documents(spark):
    docs, known = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    rows += [(10_000 + i, t, "en") for i, (_, t, _) in enumerate(rows[:9])]
    more = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = audit_rows(filter_audit.audit(more, known))
    assert got == slow_audit(rows, label_marks(known)) and len(got) == 600 * len({r[2] for r in rows})


def test_audit_of_odd_rows(spark, odd, none, labels):
    got = audit_rows(filter_audit.audit(odd, labels))
    assert got == slow_audit([(r[0], r[1], r[2]) for r in odd_rows()], label_marks(labels))
    assert filter_audit.audit(none, labels).collect() == []
    assert audit_rows(filter_audit.audit(odd, labels.limit(0))).keys() == got.keys()


def test_adjacent_swaps_visit_every_order():
    for n in range(1, 7):
        order = list(range(n))
        seen = [tuple(order)]
        for at in filter_audit.adjacent_swaps(n):
            order[at : at + 2] = order[at + 1], order[at]
            seen.append(tuple(order))
        assert len(seen) == len(set(seen)) == math.factorial(n)


def test_diagram_keeps_its_weights_under_swaps():
    rng = random.Random(1)
    weights = {m: (rng.randrange(9), rng.randrange(3), rng.randrange(2)) for m in range(32) if rng.random() < 0.7}
    diagram = filter_audit.Diagram(weights, 5)

    def weight(mask):
        node = diagram.root
        for f in diagram.order:
            node = diagram.nodes[node][mask >> f & 1]
        return diagram.nodes[node][2]

    for at in [0, 3, 1, 2, 2, 0, 1, 3]:
        diagram.swap(at)
        assert all(weight(m) == weights.get(m, (0, 0, 0)) for m in range(32))
        assert diagram.nodes[diagram.root][2] == tuple(map(sum, zip(*weights.values())))


def test_equal_diagrams_are_shared():
    diagram = filter_audit.Diagram({m: (1, 0, 0) for m in range(32)}, 5)
    assert len(diagram.nodes) == 6  # one node a level


# --- toxicity -------------------------------------------------------------------------------------------------


def slow_segments(scores):
    """By the definition: split at the best segment, then each side by itself."""

    def inside(a, b):
        best = max(((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
        if best is None or best[0] <= 0:
            return []
        _, _, _, i, j = best
        return inside(a, i) + [(i, j, best[0])] + inside(j, b)

    return inside(0, len(scores))


def test_segments_are_the_maximal_ones():
    rng = random.Random(4)
    for _ in range(400):
        # Powers of two in the fraction: sums are exact and no two segments tie.
        scores = [rng.randrange(-40, 25) + rng.getrandbits(20) / 2**20 for _ in range(rng.randrange(0, 14))]
        got = toxicity.segments(np.array(scores, np.float64))
        assert [(s, e) for s, e, _ in got] == [(s, e) for s, e, _ in slow_segments(scores)]
        assert np.allclose([x for *_, x in got], [x for *_, x in slow_segments(scores)])


def test_segments_take_linear_time():
    import time

    rng = np.random.default_rng(1)
    took = []
    for n in (200_000, 400_000):
        cases = [rng.normal(-0.1, 1, n), np.tile([2.0, -1.0], n // 2), np.tile([1.0, -2.0], n // 2)]
        start = time.perf_counter()
        for scores in cases:
            toxicity.segments(scores)
        took.append(time.perf_counter() - start)
    assert took[1] < 3.5 * took[0]


def test_law_of_best_segments_is_recovered():
    """Best segments of random walks: the rate solves E exp(rate * s) = 1, and one text in twenty exceeds its limit."""
    rng = np.random.default_rng(2)
    n = rng.integers(200, 2000, 1500)
    best = [max((x for *_, x in toxicity.segments(rng.choice([1.0, -1.0], k, p=[0.25, 0.75]))), default=0) for k in n]
    rate, k = toxicity.fit_law(np.array(best), n)
    assert abs(rate - math.log(3)) < 0.12
    model = toxicity.Model(rate=rate, k=k)
    above = np.mean([model.surprise(b, m) > -math.log(0.05) for b, m in zip(best, n)])
    assert above < 0.08


def test_scores_fall_back_to_beginnings():
    counts = {b"idi ": (50, 50), b"idio ": (50, 50), b"idiot": (48, 48), b"the": (100, 1000), b"idiom": (1, 60), b"idi": (0, 2)}
    scores = toxicity.log_odds(counts, 100, 1000)
    model = toxicity.Model(scores)
    score = lambda w: model.score(w) + toxicity.DRIFT
    assert score(b"Idiot!") > 2 and score(b"idiotic") > 2 and abs(score(b"the")) < 0.2
    assert score(b"idiom") < score(b"idiots") - 1 and score(b"unseen") == 0 and score(b"###") == 0


def held_out_counts(spark, folder):
    docs, known = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score_documents(docs, known)
    rows = scored.join(known, "doc_id").filter("held_out").select("score", "predicted", "toxic").collect()
    hits = sum(r.predicted and r.toxic for r in rows)
    return hits / sum(r.toxic for r in rows), sum(r.predicted and not r.toxic for r in rows) / len(rows), rows


def test_held_out_accuracy(spark):
    """On labels that training never sees: most toxic texts are caught and clean ones left alone."""
    recall, false_alarms, rows = held_out_counts(spark, "/root/testdata/sf0.1")
    yes = [r.score for r in rows if r.toxic]
    no = sorted(r.score for r in rows if not r.toxic)
    auc = sum(np.searchsorted(no, s) for s in yes) / (len(yes) * len(no))
    assert recall > 0.88 and false_alarms < 0.01 and auc > 0.95


def test_passages_are_found_where_they_were_planted(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    bad = ["vile", "filth", "scoundrel", "wretch"]
    rows, spans = [], {}
    for i in range(600):
        text = [rng.choice(words) for _ in range(rng.randrange(80, 300))]
        if i % 4 == 0:
            at = rng.randrange(10, 60)
            text[at:at] = [rng.choice(bad) + rng.choice(["", "!", "s"]) for _ in range(4)]
            spans[i] = (at, at + 4)
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i in spans)) for i in range(600)], "doc_id long, toxic int")
    model = toxicity.model_of(docs, known)
    got = {}
    for r in toxicity.passages(docs, model).collect():
        got.setdefault(r.doc_id, []).append(r)
        assert r.expected < toxicity.EXPECTED and len(r.passage.split()) == r.n_words
    found = [i for i, (s, e) in spans.items() if any(r.first_word <= s and s + 1 < r.first_word + r.n_words for r in got.get(i, []))]
    assert len(found) > 0.95 * len(spans) and len(set(got) - set(spans)) < 0.05 * 450


def test_toxicity_of_odd_rows(spark, odd, none, labels):
    got = toxicity.score_documents(odd, labels).collect()
    key = lambda x: (x is None, x)
    assert sorted((r.doc_id for r in got), key=key) == sorted((r[0] for r in odd_rows()), key=key)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert {r.held_out for r in got if r.doc_id is None} == {True}
    assert toxicity.score_documents(none, labels).collect() == []
    assert len(toxicity.score_documents(odd, labels.limit(0)).collect()) == len(got)  # nothing to learn from
    only = labels.filter("toxic = 0")
    assert all(r.predicted == 0 for r in toxicity.score_documents(odd, only).collect())
