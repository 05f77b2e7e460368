"""Sharding, ranked search and spelling variants against plain statements of what they compute."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tessera.llm import impact, queries_index, sharding, spelling

SF = "/root/testdata/sf0.001"
EXTRA = ["row", "size", "shard", "curve", "place", "term", "block", "word", "n", "rest", "dim_0", "a.b: c, d"]
LONG = "Verwaltungsgericht " * 20_000
ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n", None, None), (4, "Colour colour color colors", "en", "b"), (5, "Colour colour color colors", "en", "b"),
    (5, "Colour colour color colors", "en", "b"), (6, "größe Größe grösse GRÖßE größen", "de", "b"), (None, "no id at all, colour", "fr", None), (None, None, None, None),
    (7, LONG, "de", "c"), (8, "tail x1 42 日本 colour's", "ja", "a"), (9, "verwaltungsgerichte verwaltungsgerichte verwaltungsgerichte", "de", "c"), (-3, "colours colours colours colour", "en", "b"),
]
ITEMS = [(1, "Colour of the größe"), (2, None), (3, ""), (4, "nothing known"), (1, "Colour of the größe"), (5, "x1 42 verwaltungsgericht colour COLOUR"), (None, "tail")]


@pytest.fixture(scope="module")
def docs(spark):
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in EXTRA)
    return spark.createDataFrame([(*r, *EXTRA) for r in ROWS], schema)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(*r, "x", "y") for r in ITEMS], "item_id long, text string, doc_id string, query string")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries_index.QUERIES))
def test_same_rows_as_sql(spark, con, name):
    got = queries_index.QUERIES[name](spark, SF)
    want = con.execute(queries_index.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r)) for r in got.select(*columns).collect())


# --- Sharding -------------------------------------------------------------------------------------


@pytest.mark.parametrize(("n", "bits"), [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_each_cell_once_by_single_steps(spark, n, bits):
    from pyspark.sql import functions as F

    cells = spark.range(1 << (n * bits)).select(*[F.expr(f"(id >> {bits * k}) & {(1 << bits) - 1}").alias(f"c{k}") for k in range(n)])
    rows = cells.withColumn("at", sharding.curve_index([F.col(f"c{k}") for k in range(n)], bits)).sort("at").collect()
    assert [r["at"] for r in rows] == list(range(1 << (n * bits)))
    assert all(sum(abs(a[k] - b[k]) for k in range(n)) == 1 for a, b in zip(rows, rows[1:], strict=False))


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_shards_are_even(docs, law):
    got = sharding.decide(docs, law=law, shards=4).collect()
    size = {i: len((r[1] or "").encode()) + 1 for i, r in enumerate(ROWS)}
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((r[0], size[i], zlib.crc32((r[1] or "").encode())) for i, r in enumerate(ROWS))
    slots = {s: sorted(r["slot"] for r in got if r["shard"] == s) for s in {r["shard"] for r in got}}
    assert set(slots) <= set(range(4)) and all(v == list(range(len(v))) for v in slots.values())
    if law == "rows":
        assert {len(v) for v in slots.values()} <= {len(ROWS) // 4, len(ROWS) // 4 + 1} and len(slots) == 4
    assert {(r["law"], r["grown_shard"]) for r in got} == {(law, None)}


def test_bytes_of_shards_differ_by_single_rows(spark):
    rows = [(k, "x" * (k * 37 % 101), "en", f"s{k % 5}") for k in range(2000)]
    got = sharding.decide(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), law="bytes").collect()
    sums = Counter()
    for r in got:
        sums[r["shard"]] += r["size"]
    assert set(sums) == set(range(16)) and max(sums.values()) - min(sums.values()) <= 2 * 101


def test_dimensions_of_many_values_and_one_hot_value(spark, monkeypatch):
    monkeypatch.setattr(sharding.skew, "BROADCAST_ROWS", 10)
    rows = [(k, f"text {k}", "en", "hot" if k % 2 else f"s{k:04}") for k in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {tuple(r) for r in sharding.decide(df).collect()}
    monkeypatch.undo()
    assert got == {tuple(r) for r in sharding.decide(df).collect()}
    assert set(Counter(r[4] for r in got).values()) == {62, 63}


def test_empty_and_few(docs):
    assert sharding.decide(docs.limit(0)).collect() == []
    one = sharding.decide(docs.filter("doc_id = 7")).collect()
    assert [(r["shard"], r["slot"]) for r in one] == [(0, 0)]


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_written_shards_hold_all_rows_and_prune(spark, tmp_path, law):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = f"file://{tmp_path}/shards"
    sharding.write_shards(docs, path, law=law, files=32)
    back = spark.read.parquet(path)
    assert Counter(map(tuple, back.drop(sharding.SHARD).collect())) == Counter(map(tuple, docs.collect()))
    want = Counter((r["doc_id"], r["shard"]) for r in sharding.decide(docs, law=law).collect())
    assert Counter((r["doc_id"], r[sharding.SHARD]) for r in back.collect()) == want
    zones = sharding.zone_map(spark, path, ["lang", "source", "n_chars"])
    first = docs.agg({"source": "min"}).first()[0]
    between = {"source": (first, first), "n_chars": (0, 400)}
    assert sharding.files_for(zones, between).count() < zones.count()
    got = Counter(map(tuple, sharding.read_between(spark, path, zones, between).collect()))
    assert got == Counter(map(tuple, docs.filter((docs["source"] == first) & docs["n_chars"].between(0, 400)).collect()))


def test_written_shards_of_awkward_rows(spark, docs, tmp_path):
    sharding.write_shards(docs, f"file://{tmp_path}/awkward", shards=4)
    back = spark.read.parquet(f"file://{tmp_path}/awkward")
    assert back.drop(sharding.SHARD).columns == docs.columns
    assert Counter(map(tuple, back.drop(sharding.SHARD).collect())) == Counter(map(tuple, docs.collect()))


# --- Ranked search --------------------------------------------------------------------------------


def ranked(rows, queries, k=10):
    """By the formula, document by document."""
    terms = [re.findall("[0-9a-z\u0080-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) for _, t in rows]
    n_docs, n_terms = sum(map(bool, terms)), sum(map(len, terms))
    df = Counter(t for ts in terms for t in set(ts))
    counts = list(map(Counter, terms))
    out = []
    for item, text in queries:
        asked = set(re.findall("[0-9a-z\u0080-\U0010ffff]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")))
        scores = []
        for (d, _), ts, c in zip(rows, terms, counts, strict=True):
            s = 0
            for t in asked & set(c):
                m = 10 + 90 * len(ts) * n_docs // n_terms
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if s:
                scores.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k])]
    return Counter(out)


def answers(df):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect())


def test_ranks(docs, items):
    pairs = [r[:2] for r in ROWS]
    assert answers(impact.rank(docs, items)) == ranked(pairs, ITEMS)
    assert answers(impact.rank(docs, items, k=2)) == ranked(pairs, ITEMS, 2)


@pytest.mark.parametrize("limits", [{"BLOCK": 3}, {"BLOCK_ENTRIES": 2}, {"MAX_TERMS": 0}, {"QUERY_BYTES": 20}])
def test_ranks_by_small_blocks_and_groups(docs, items, monkeypatch, limits):
    for k, v in limits.items():
        monkeypatch.setattr(impact, k, v)
    assert answers(impact.rank(docs, items)) == ranked([r[:2] for r in ROWS], ITEMS)


def test_many_ties_and_a_stored_index(spark):
    rng = np.random.default_rng(1)
    rows = [(int(d), " ".join(f"t{x}" for x in rng.integers(0, 30, 6))) for d in rng.permutation(700)] + [(k, "tie tie") for k in range(2000, 2300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    asked = [(k, f"t{k} t{k + 1} t{k + 2} t{k + 3} tie") for k in range(20)] + [(99, "tie")]
    index = impact.build_index(df)
    queries = impact.queries_of(spark.createDataFrame(asked, "item_id long, text string"))
    for k in (1, 7, 64, 1000):
        assert answers(impact.search(index, queries, k)) == ranked(rows, asked, k)


def test_search_of_empty_tables(docs, items):
    assert impact.rank(docs.limit(0), items).collect() == []
    assert impact.rank(docs, items.limit(0)).collect() == []


def test_carry_arithmetic():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1 << 35, (7, 200))
    maps = []
    for v in values:
        n, bits = impact.sliced_bits(v)
        maps.append(impact.spread(np.arange(200), n, bits, 4, 36))
    total = impact.summed(np.stack(maps))
    want = values.sum(axis=0)
    assert impact.best(total, 200) and dict(impact.best(total, 500)) == dict(enumerate(want.tolist()))
    top = sorted(range(200), key=lambda k: (-want[k], k))[:9]
    assert sorted(impact.best(total, 9)) == sorted((k, want[k]) for k in top)


# --- Spelling variants ----------------------------------------------------------------------------


def near_by_edits(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def spelled(rows, least=3):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= least}
    near = {w: [x for x in n if near_by_edits(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x.encode()), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root(w)) for w in n}


def spellings(df):
    return {tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()}


def test_spellings(docs):
    assert spellings(spelling.variants(docs)) == spelled([r[:2] for r in ROWS])
    assert spelling.variants(docs.limit(0)).collect() == []


@pytest.mark.parametrize("group", [0, 4, 64])
def test_spellings_of_many_words_with_one_half(spark, monkeypatch, group):
    """Words of one half, in two alphabets, with chains of forms; groups go down all levels."""
    monkeypatch.setattr(spelling, "GROUP", group)
    monkeypatch.setattr(spelling, "HELD", 50)
    rng = np.random.default_rng(4)
    letters = list("abé")
    words = {"".join(rng.choice(letters, size)) for size in (5, 6, 7) for _ in range(60)} | {f"verwaltung{''.join(rng.choice(letters, size))}" for size in (2, 3, 4) for _ in range(60)}
    rows = [(k, " ".join([w.replace("a", "A")] * int(rng.choice([3, 3, 7, 15, 40])))) for k, w in enumerate(sorted(words))]
    assert spellings(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == spelled(rows)


def test_a_code_point_goes_by_the_crc(spark):
    rows = [(k, "Straßenbahn straßenbahn") for k in range(3000)]
    got = spellings(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == spelled(rows) and len(got) > 5


# --- The catalogue, and vectors near the threshold ------------------------------------------------


def test_all_operators_are_registered():
    import __spark_entry__ as entry

    found = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in found if k.startswith("op")} and "pipeline" in found


@pytest.mark.parametrize("size", [64, 384])
def test_vectors_near_the_threshold_are_found(spark, size):
    """Pairs with a cosine of 0.95 to 0.96, among vectors of 40 clusters."""
    from tessera.llm import embedding_dedup

    rng = np.random.default_rng(size)
    centres = rng.normal(size=(40, size))
    rows = []
    for k in range(400):
        a = centres[k % 40] + rng.normal(size=size)
        a /= np.linalg.norm(a)
        b = rng.normal(size=size)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        cosine = rng.uniform(0.9501, 0.96)
        rows += [a, cosine * a + np.sqrt(1 - cosine**2) * b]
    x = np.array(rows)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.link(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(rows)], "vec_id long, embedding array<double>")).collect()}
    assert all(got[k] <= near[k].sum() for k in got)
    assert sum(got.values()) >= 0.97 * near.sum() >= 0.97 * 800
