"""The near-duplicate stage against brute force over all pairs."""

from collections import defaultdict

import numpy as np

from tessera.llm import line_dedup, simhash


def sets_of(rows):
    return [simhash.shingle_set(simhash.words_of((t or "").encode()), 5) for _, t in rows]


def components_of(sets, similarity=0.8):
    """The label of each set's component, from all pairs that share a shingle."""
    label, holders = list(range(len(sets))), defaultdict(list)
    for k, s in enumerate(sets):
        for h in s.tolist():
            holders[h].append(k)

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    for k, s in enumerate(sets):
        shared = defaultdict(int)
        for h in s.tolist():
            for other in holders[h]:
                if other < k:
                    shared[other] += 1
        for other, both in shared.items():
            if both >= similarity * (len(s) + len(sets[other]) - both):
                x, y = sorted((top(k), top(other)))
                label[y] = x
    return [top(k) for k in range(len(sets))]


def check(spark, rows):
    """keep_one and near_duplicates over rows of distinct ids."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels, least = components_of(sets_of(rows)), {}
    for (d, _), c in zip(rows, labels, strict=True):
        least[c] = min(d, least.get(c, d))
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df).collect()}
    assert got == {d: least[c] for (d, _), c in zip(rows, labels, strict=True)}
    assert sorted(r["doc_id"] for r in simhash.keep_one(df).collect()) == sorted(least.values())


def test_all_merges_of_a_whole_table_are_found(spark):
    docs = line_dedup.dedup_lines(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    check(spark, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def edited(rng, words, share):
    """``words`` with a block of ``share`` of them replaced, which takes about as many shingles."""
    n = int(len(words) * share)
    at = int(rng.integers(0, len(words) - n + 1))
    return [*words[:at], *[f"e{x}" for x in rng.integers(0, 1 << 60, n)], *words[at + n :]]


def test_near_copies_in_a_large_bucket_are_found(spark):
    """Over 256 texts of nearly one word set: a template, and pairs alike only to each other."""
    rng, rows = np.random.default_rng(11), []
    words = [f"w{k}" for k in range(120)]
    for _ in range(300):
        rows.append((len(rows), " ".join(edited(rng, words, 0.05))))
    for _ in range(150):
        own = list(rng.permutation(words))
        rows += [(len(rows), " ".join(own)), (len(rows) + 1, " ".join(edited(rng, own, 0.03)))]
    check(spark, rows)


def test_the_true_copy_behind_nearer_fingerprints_is_found(spark):
    """Texts of one word set in other orders are nearer by their words than the copy by shingles."""
    rng, rows = np.random.default_rng(12), []
    words = [f"w{k}" for k in range(100)]
    for _ in range(40):
        own = list(rng.permutation(words))
        for _ in range(10):
            rows.append((len(rows), " ".join(rng.permutation(edited(rng, words, 0.01)))))
        rows += [(len(rows), " ".join(own)), (len(rows) + 1, " ".join(edited(rng, own, 0.06)))]
    check(spark, rows)


def test_links_between_texts_of_one_word_set_are_found(spark):
    """Many orders of the same words, each with a copy that repeats its last words."""
    rng, rows = np.random.default_rng(13), []
    words = [f"w{k}" for k in range(80)]
    for _ in range(20):
        own = list(rng.permutation(words))
        rows += [(len(rows), " ".join(own)), (len(rows) + 1, " ".join([*own, *own[-6:]]))]
    check(spark, rows)


def test_null_and_repeated_ids_cost_no_other_row(spark):
    rng = np.random.default_rng(14)
    a, b, c, d, e = (" ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 100)) for _ in range(5))
    rows = [
        (1, a), (None, f"{a} end"),  # the null row goes
        (None, b),  # unique: stays
        (2, c), (7, f"{c} end"), (7, d),  # only the copy under 7 goes
        (None, e), (None, f"{e} end"), (None, f"{e} end"),  # null ids only: one stays
        (9, None), (9, ""),  # equal ids and shingles: one stays
    ]
    got = [(r["doc_id"], r["text"]) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(got) == 6
    assert {(1, a), (None, b), (2, c), (7, d)} <= set(got)
    assert len([1 for i, t in got if i is None and t.startswith(e)]) == 1 and len([1 for i, _ in got if i == 9]) == 1
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    assert sorted(str(r["component_id"]) for r in found if r["doc_id"] is None) == ["1", "None", "None", "None", "None"]
