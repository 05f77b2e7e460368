"""Edge cases of the operators that their own tests leave out, each against a plain statement."""

from collections import Counter

import numpy as np
import pytest

from tessera.llm import embedding_dedup, exact_dedup, simhash, substring_dedup, tokens


def test_a_filter_too_large_to_broadcast_is_joined(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LEAST_BITS", exact_dedup.MAX_FILTER_BITS)
    texts = [f"text {k % 40}" for k in range(60)] + [None, "", "  "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keys = ["".join((t or "").split()) for t in texts]
    sizes = Counter(keys)
    got = {r["doc_id"]: (r["group_size"], r["keep_id"]) for r in exact_dedup.decide(df).collect()}
    for d, k in enumerate(keys):
        own = [i for i, x in enumerate(keys) if x == k]
        best = max(own, key=lambda i: (len(texts[i] or ""), -i))
        assert got[d] == (sizes[k], best)


def test_filter_never_clears_a_repeat(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_FILTER_BITS", exact_dedup.BLOCK_BITS)
    keys = spark.range(12_000).selectExpr("sha2(string(id % 9000), 256) AS k")
    tested = exact_dedup.RepeatFilter(keys, "k", 12_000).test(keys)
    again = keys.groupBy("k").count().filter("count > 1")
    assert tested.filter("not may_repeat").join(again, "k").count() == 0
    assert tested.count() == 12_000


def test_a_digest_appended_twice_counts_once(spark, tmp_path):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame([(1, "one text"), (2, "another text"), (3, "one text"), (None, None)], "doc_id long, text string")
    cache = tokens.DigestCache(spark, str(tmp_path / "cache"))
    want = sorted(map(repr, tokens.token_counts(df, path, cache).collect()))
    stored = cache.read(tokens.tokenizer_digest(path))
    cache.append(spark.createDataFrame(stored.collect(), stored.schema), tokens.tokenizer_digest(path))
    assert sorted(map(repr, tokens.token_counts(df, path, cache).collect())) == want


def test_vectors_of_two_lengths_and_odd_ids(spark):
    rng = np.random.default_rng(3)
    rows = []
    for size in (8, 12):
        for k in range(30):
            v = rng.normal(size=size)
            rows += [(len(rows), v.tolist()), (len(rows) + 1, (v + rng.normal(size=size) * 0.02).tolist())]
    rows += [(5, rows[5][1]), (None, rows[0][1]), (900, None), (901, []), (902, [0.0] * 8), (903, [float("nan")] * 8)]
    df = spark.createDataFrame([(*r, "x", r[0]) for r in rows], "vec_id long, embedding array<double>, cid string, n long")
    got = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.link(df).collect())
    good = [k for k, (i, v) in enumerate(rows) if i is not None and v and np.isfinite(v).all() and any(v)]
    near = {k: [j for j in good if j != k and len(rows[j][1]) == len(rows[k][1]) and np.dot(rows[j][1], rows[k][1]) >= 0.95 * np.linalg.norm(rows[j][1]) * np.linalg.norm(rows[k][1])] for k in good}
    label = {k: rows[k][0] for k in good}
    for _ in rows:
        label = {k: min([label[k], *[label[j] for j in near[k]]]) for k in good}
    assert got == Counter((rows[k][0], len(near[k]) if k in near else 0, label.get(k, rows[k][0])) for k in range(len(rows)))


@pytest.mark.parametrize("group", [2, 8])
def test_passages_of_groups_that_do_not_fit(spark, monkeypatch, group):
    """One frequent passage between unlike words, some texts very long: prefixes grow through all lengths."""
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    rng = np.random.default_rng(5)
    passage = [f"p{k}" for k in range(40)]
    rows = []
    for k in range(40):
        cut = int(rng.integers(10, 41))
        own = [f"u{x}" for x in rng.integers(0, 1 << 40, 3000 if k % 13 == 0 else 30)]
        rows.append((k, " ".join([*own, *passage[:cut], *[f"v{x}" for x in rng.integers(0, 1 << 40, 40)]])))
    words = [t.split() for _, t in rows]
    seen = Counter(tuple(w[a : a + 35]) for w in words for a in range(len(w) - 34))
    want = {}
    for (d, _), w in zip(rows, words, strict=True):
        gone = {p for a in range(len(w) - 34) if seen[tuple(w[a : a + 35])] > 1 for p in range(a, a + 35)}
        want[d] = (len(w), " ".join(x for p, x in enumerate(w) if p not in gone))
    got = {r["doc_id"]: (r["n_words"], r["kept"]) for r in substring_dedup.strip_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_near_duplicates_of_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, row string, sig int, data string, `a.b` int")
    assert simhash.keep_one(none).columns == none.columns and simhash.keep_one(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    long = " ".join(f"w{k}" for k in range(30_000))
    rows = [(3, long, "r", 1, "d", 1), (2, f"{long} more", "r", 2, "d", 1), (1, "short", "r", 3, "d", 2), (None, None, "r", 4, "d", 3), (7, "", None, None, None, None)]
    kept = simhash.keep_one(spark.createDataFrame(rows, none.schema))
    assert kept.columns == none.columns
    assert sorted(r["sig"] or 0 for r in kept.collect()) == [0, 2, 3]
