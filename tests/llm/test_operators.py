"""Each operator against a plain statement of what it computes, on small and awkward tables."""

import hashlib
import itertools
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tessera.llm import embedding_dedup, exact_dedup, line_dedup, mixing, packing, simhash, substring_dedup, tokens, toxicity, warc, words

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LONG = "This line is longer than twenty characters."
PASSAGE = " ".join(f"word{k}" for k in range(60))
ROWS = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \t\n", "de", None, 3),
    (4, "one two three four", "en", "b", 18),
    (5, "one two three four", "en", "b", 18),
    (6, "ONE  two\nthree four", "en", "b", 19),
    (7, f"{LONG}\nfoo\n{LONG}", "fr", "a", 80),
    (8, f"bar\n  {LONG.upper()}  \n", "fr", "a", 60),
    (9, f"{LONG}\n\n", "es", "c", 50),
    (10, f"start {PASSAGE} end", "en", None, 400),
    (11, f"{PASSAGE}", "en", "c", 400),
    (12, f"xé 日本 {PASSAGE} … <|endoftext|> y", "en", "c", 420),
    (13, "long " * 30_000 + "tail", "en", "c", 150_004),
    (13, "another text of the same id", "en", "c", 27),
    (None, "no id at all", None, None, None),
    (None, None, None, None, None),
    (14, "repeated row", "en", "a", 12),
    (14, "repeated row", "en", "a", 12),
]
EXTRA = ["row", "size", "fp", "kept", "label", "h1", "digest", "rid", "n", "a.b: c, d"]


@pytest.fixture(scope="module")
def docs(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c.replace('`', '``')}` string" for c in EXTRA)
    return spark.createDataFrame([(*r, *EXTRA) for r in ROWS], schema)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def text_of(r):
    return r[1] or ""


# --- Exact de-duplication -------------------------------------------------------------------------


def exact_spec(data):
    groups = defaultdict(list)
    for d, t, *_ in data:
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append((d, len(t or "")))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))[0]
        out += [(d, keep, len(members), d == keep, hashlib.sha256(norm.encode()).hexdigest()) for d, _ in members]
    return sorted(out, key=repr)


def test_exact(docs, none):
    assert rows(exact_dedup.decide(docs)) == exact_spec(ROWS)
    assert rows(exact_dedup.decide(none)) == []


def test_exact_with_sharded_filters(docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MAX_FILTER_BITS", exact_dedup.BLOCK_BITS)
    monkeypatch.setattr(exact_dedup, "BITS_PER_ROW", exact_dedup.BLOCK_BITS // 8)
    assert rows(exact_dedup.decide(docs)) == exact_spec(ROWS)


def test_exact_keeps_all_columns(docs):
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} >= {3, 6, 7, 8, 10, 11, 12, 13}


# --- Mixing -----------------------------------------------------------------------------------------


def test_mixing(docs, none):
    got = mixing.mix(docs).collect()
    size = Counter()
    for r in ROWS:
        size[r[3]] += len(WORD.findall(text_of(r).encode()))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight, total = {s: k % 3 + 1 for k, s in enumerate(names)}, sum(size.values())
    capped, target = set(), {}
    while True:
        left, w = total - sum(3 * size[s] for s in capped), sum(weight[s] for s in names if s not in capped)
        target = {s: 3 * size[s] if s in capped else left * weight[s] / w for s in names}
        over = {s for s in names if s not in capped and target[s] > 3 * size[s]}
        if not over:
            break
        capped |= over
    largest = Counter()
    for r in got:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    taken = Counter()
    for r in got:
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in names)
    assert len(got) == len(ROWS)
    assert rows(mixing.mix(docs)) == sorted((tuple(r) for r in got), key=repr)
    assert rows(mixing.mix(none)) == []


def test_mixing_repeats_rows(docs):
    times = Counter()
    for r in mixing.mix(docs).collect():
        times[r["doc_id"], r["source"], r["size"]] += r["copies"]
    out = mixing.repeated(docs)
    assert out.columns == docs.columns
    seen = Counter((r["doc_id"], r["source"], len(WORD.findall((r["text"] or "").encode()))) for r in out.collect())
    assert seen == +times


# --- Line de-duplication ------------------------------------------------------------------------------


def test_lines(docs, none):
    keys = defaultdict(list)
    for k, r in enumerate(ROWS):
        for line in set(line_dedup.line_key(x) for x in text_of(r).encode().split(b"\n")):
            if len(line.decode()) >= 20:
                keys[line].append((k, r[0]))
    out = []
    for r in ROWS:
        lines, kept = text_of(r).encode().split(b"\n"), []
        for x in lines:
            own = keys.get(line_dedup.line_key(x), [])
            if len(own) < 3 or r[0] == max((d for _, d in own if d is not None), default=None):
                kept.append(x)
        out.append((r[0], len(lines), len(lines) - len(kept), hashlib.sha256(b"\n".join(kept)).hexdigest()))
    got = rows(line_dedup.decide(docs))
    assert got == sorted(out, key=repr)
    assert sum(x[2] for x in got) == 3
    assert rows(line_dedup.decide(none)) == []
    kept = line_dedup.dedup_lines(docs)
    assert kept.columns == docs.columns
    assert sum(r["text"] is None for r in kept.collect()) == sum(r[1] is None for r in ROWS)


def test_line_runs_are_levelled(spark, docs):
    store = line_dedup.LineRuns(spark, fanout=2)
    texts = [[(1, f"{LONG}\nshort"), (2, "the second line is long as well")], [(3, f"{LONG}\nanother line that is long enough")], [(4, f"{LONG}\nthe second line is long as well\nnew")]]
    kept = [rows(store.admit(spark.createDataFrame(t, "doc_id long, text string"))) for t in texts]
    assert kept[0] == [(1, f"{LONG}\nshort"), (2, "the second line is long as well")]
    assert kept[1] == [(3, "another line that is long enough")]
    assert kept[2] == [(4, "new")]
    assert [len(level) for level in store.levels] == [1, 1]


# --- Tokens and packing -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizers():
    import public_tokenizers
    from tokenizers import Tokenizer

    return {n: (public_tokenizers.path(n), Tokenizer.from_file(public_tokenizers.path(n))) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}


def test_token_counts(spark, docs, none, tokenizers, tmp_path):
    path, library = tokenizers["byte_bpe_50k.json"]
    want = []
    for r in ROWS:
        n = len(library.encode(text_of(r), add_special_tokens=False).ids)
        want.append((r[0], len(text_of(r).encode()), n, n > 512))
    cache = tokens.DigestCache(spark, f"file://{tmp_path}/cache")
    assert rows(tokens.token_counts(docs, path, cache)) == sorted(want, key=repr)
    stored = cache.read(tokens.tokenizer_digest(path)).count()
    assert stored == len({text_of(r) for r in ROWS})
    assert rows(tokens.token_counts(docs, path, cache)) == sorted(want, key=repr)
    assert cache.read(tokens.tokenizer_digest(path)).count() == stored
    assert rows(tokens.token_counts(none, path)) == []


def test_units_give_the_ids_of_the_library(tokenizers):
    rng = np.random.default_rng(4)
    bits = ["a", "B", "é", "É", "J̌", ".", ",", "'s", "<|endoftext|>", "<|ENDOFTEXT|>", " ", "  ", "\n", "\t", " ", "…", "Σ", "İ", "7", "x" * 130, "_", "\x1c", "日本", "don't", "́", "×."]
    texts = ["".join(rng.choice(bits, rng.integers(0, 12))) for _ in range(3000)]
    path, library = tokenizers["word_bpe_49k.json"]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    for most in (10, 100_000):
        encoder, got = words.WordEncoder(path, most), []
        for a, b in words.slices([t.encode() for t in texts], 5000):
            ids, at = encoder.encode([t.encode() for t in texts[a:b]])
            got += [ids[x:y].astype("<u4").tobytes() for x, y in itertools.pairwise(at)]
        assert got == want
    path, library = tokenizers["byte_bpe_50k.json"]
    units = tokens.Units(path, len)
    found, sizes = units.values(texts)
    ends = np.cumsum([0, *sizes])
    assert [sum(found[a:b]) for a, b in itertools.pairwise(ends)] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_packing(docs, none, tokenizers):
    path, library = tokenizers["word_bpe_49k.json"]
    got = packing.pack(docs, path).collect()
    ids = defaultdict(list)
    for r in ROWS:
        ids[r[0]].append(np.array([*library.encode(text_of(r), add_special_tokens=False).ids, 1], dtype="<u4"))
    want = Counter()
    for d, lists in ids.items():
        for x in lists:
            for a in range(0, len(x), 2048):
                want[d, a, len(x[a : a + 2048]), zlib.crc32(x[a : a + 2048].tobytes()), len(x)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    spans = defaultdict(list)
    for r in got:
        spans[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in spans.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    assert rows(packing.pack(none, path)) == []


def test_packed_sequences_hold_the_ids(docs, tokenizers):
    path, library = tokenizers["word_bpe_49k.json"]
    out = packing.packed_sequences(docs, path).collect()
    total = Counter()
    for r in out:
        n = sum(s > 0 for s in r["segments"])
        assert len(r["ids"]) == 2048 or len(r["ids"]) == n and n & (n - 1) == 0
        total.update(i for i, s in zip(r["ids"], r["segments"], strict=True) if s)
    want = Counter()
    for r in ROWS:
        want.update([*library.encode(text_of(r), add_special_tokens=False).ids, 1])
    assert total == want


def test_plan_wastes_little():
    rng = np.random.default_rng(1)
    histogram = Counter(rng.integers(1, 2049, 20_000).tolist())
    plan = packing.plan(histogram)
    back = Counter()
    for pattern, n in plan:
        assert sum(pattern) <= 2048
        for x in pattern:
            back[x] += n
    assert back == histogram
    used, packs = sum(sum(p) * n for p, n in plan), sum(n for _, n in plan)
    assert used / (packs * 2048) > 0.98


# --- Repeated passages ------------------------------------------------------------------------------


def passages_spec(data):
    lists = [WORD.findall((t or "").encode()) for _, t, *_ in data]
    seen = Counter(tuple(w[i : i + 35]) for w in lists for i in range(len(w) - 34))
    out = []
    for r, w in zip(data, lists, strict=True):
        gone = np.zeros(len(w), dtype=bool)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = True
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((r[0], len(w), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group", [1, 256])
def test_passages(docs, none, group, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    small = docs.filter("doc_id is null or doc_id <> 13 or length(text) < 1000")
    data = [r for r in ROWS if len(text_of(r)) < 100_000]
    assert rows(substring_dedup.strip_repeats(small).drop("kept")) == passages_spec(data)
    assert rows(substring_dedup.strip_repeats(none)) == []


def test_passages_in_periodic_and_shifted_texts(spark):
    rng = np.random.default_rng(2)
    vocabulary = [f"w{k}" for k in range(12)]
    base = list(rng.choice(vocabulary, 400))
    data = [(1, " ".join(base)), (2, " ".join(base[37:300])), (3, "a b " * 60), (4, " ".join(base[:34])), (5, " ".join(base[100:136] + ["z"] + base[200:236]))]
    for k in range(6, 40):
        a = int(rng.integers(0, 300))
        data.append((k, " ".join([f"u{k}", *base[a : a + int(rng.integers(30, 80))], f"v{k}"])))
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(substring_dedup.strip_repeats(df).drop("kept")) == passages_spec(data)

def test_equal_suffixes_go_down_the_tree_once(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GROUP", 4)
    own = lambda k, side: " ".join(f"{side}{k}x{j}" for j in range(40))
    data = [(k, f"{own(k, 'a')} {PASSAGE} {own(k % 7 if k < 20 else k, 'b')}") for k in range(40)]
    members, materialise = [], substring_dedup.scratch.materialise

    def spied(df, label, *more):
        table = materialise(df, label, *more)
        if label == "prefix-members":
            members.append(table)
        return table

    monkeypatch.setattr(substring_dedup.scratch, "materialise", spied)
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(substring_dedup.strip_repeats(df).drop("kept")) == passages_spec(data)
    assert sum(t.count() for t in members) > 0
    for t in members:
        assert t.count() == t.select("gram", "body").distinct().count()


# --- Near-duplicates ----------------------------------------------------------------------------------


def fingerprint_spec(text):
    w = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), text))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_spec(nodes, near):
    label = {n: n for n in nodes}
    while True:
        new = {n: min([label[n], *[label[m] for m in near[n]]]) for n in nodes}
        if new == label:
            return label
        label = new


def test_simhash(docs, none):
    small = docs.filter("doc_id is not null")
    prints = [(r[0], fingerprint_spec(text_of(r).encode())) for r in ROWS if r[0] is not None]
    fps = {f for _, f in prints}
    label = components_spec(fps, {f: [g for g in fps if (f ^ g).bit_count() <= 2] for f in fps})
    first = defaultdict(lambda: 1 << 60)
    for d, f in prints:
        first[label[f]] = min(first[label[f]], d)
    want = sorted(((d, f, first[label[f]]) for d, f in prints), key=repr)
    got = sorted(((r["doc_id"], r["fp"] & simhash.FULL, r["component_id"]) for r in simhash.group(small).collect()), key=repr)
    assert got == want
    assert rows(simhash.group(none)) == []


def test_simhash_links_are_complete(spark):
    """Against all pairs, with a crowded neighbourhood that no small bucket holds."""
    rng = np.random.default_rng(3)
    values = {int(x) for x in rng.integers(0, 1 << 63, 300)}
    hot = int(rng.integers(0, 1 << 63))
    for _ in range(900):
        v = hot
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            v ^= 1 << int(b)
        values.add(v)
    signed = [simhash._signed(v) for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    edges = simhash.links(fps, len(values), bucket=64).collect()
    linked = defaultdict(set)
    for a, b in ((r["a"] & simhash.FULL, r["b"] & simhash.FULL) for r in edges):
        assert a != b
        linked[a].add(b)
        linked[b].add(a)
    array = np.array(sorted(values), dtype=np.uint64)
    near = {int(v): [int(x) for x in array[np.bitwise_count(array ^ v) <= 2]] for v in array}
    assert components_spec(values, linked) == components_spec(values, near)


def test_thresholds_add_up():
    bits = np.random.default_rng(5).random((500, 64)) < 0.5
    counts = (bits.T.astype(float) @ bits).astype(float)
    for m in (2, 3, 4):
        parts = simhash.partitions(counts, 500, m)
        assert sorted(b for p in parts for b in p) == list(range(64))
    price, chosen = simhash.allocate([[0, 5, 9, 20], [0, 1, 2, 3], [0, 7, 8, 30]], 0)
    assert sum(chosen) == 0 and price == min(a + b + c for (i, a), (j, b), (k, c) in itertools.product(*[list(enumerate(x)) for x in ([0, 5, 9, 20], [0, 1, 2, 3], [0, 7, 8, 30])]) if i + j + k == 3)


def test_near_duplicates_are_verified(spark):
    rng = np.random.default_rng(6)
    vocabulary = [f"t{k}" for k in range(3000)]
    data, n = [], 0
    for group in range(12):
        base = list(rng.choice(vocabulary, 400))
        for copy in range(1 + group % 4):
            text = list(base)
            for at in rng.choice(400, int(copy > 0), replace=False):
                text[at] = f"edit{n}"
            data.append((n, " ".join(text), group))
            n += 1
    df = spark.createDataFrame([(d, t) for d, t, _ in data], "doc_id long, text string")
    least = defaultdict(lambda: 1 << 60)
    for d, _, g in data:
        least[g] = min(least[g], d)
    got = dict(rows(simhash.near_duplicates(df)))
    assert got == {d: least[g] for d, _, g in data}
    assert {r["doc_id"] for r in simhash.keep_one(df).collect()} == set(least.values())


def test_embeddings(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(150, 64))
    data = [(k, v.tolist()) for k, v in enumerate(base)]
    for k in range(150, 400):
        v = base[k % 9] + rng.normal(size=64) * rng.choice([0.02, 0.05, 0.08])
        data.append((k, v.tolist()))
    data += [(400, base[0].tolist()), (401, None), (402, [0.0] * 64), (403, [float("nan")] * 64), (404, [1.0] * 63), (405, [None] + [1.0] * 63), (406, [float("inf")] + [1.0] * 63), (407, [])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    good = [(k, v) for k, v in data if v and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = np.array([v for _, v in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    ids = [k for k, _ in good]
    degree = {k: 0 for k, _ in data} | {k: int(near[i].sum()) - 1 for i, k in enumerate(ids)}
    label = {k: k for k, _ in data} | components_spec(ids, {k: [ids[j] for j in np.flatnonzero(near[i])] for i, k in enumerate(ids)})
    got = {r["vec_id"]: r for r in embedding_dedup.link(df).collect()}
    assert all(got[k]["n_links"] <= degree[k] for k in degree)
    assert sum(r["n_links"] for r in got.values()) >= 0.97 * sum(degree.values())
    assert np.mean([got[k]["component_id"] == label[k] for k in label]) > 0.97
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
    assert embedding_dedup.link(df.limit(0)).count() == 0


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 8)
    monkeypatch.setattr(embedding_dedup.in_cells, "__defaults__", (8,))
    rng = np.random.default_rng(8)
    centre = rng.normal(size=64)
    x = np.concatenate((centre + rng.normal(size=(120, 64)) * 0.03, rng.normal(size=(60, 64))))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in embedding_dedup.link(df).collect()}
    assert all(got[k]["n_links"] == 119 and got[k]["component_id"] == 0 for k in range(120))


# --- WARC -----------------------------------------------------------------------------------------------


def test_warc(spark):
    big = "<html>" + "xé" * 700 + "</html>"
    data = [(1, "http://a/1", big), (2, "http://a/2", big), (3, None, big), (4, "http://a/\n4", "small"), (5, "http://a/5", "small"), (6, "u", None), (None, "u", big), (7, "u", "y" * 300_000), (7, "u", "y" * 300_000), (8, "WARC/1.1\r\n\r\n", "WARC/1.1\r\nContent-Length: 5\r\n\r\n" * 60), (9, "u", "z" * 999), (10, "u", "z" * 999)]
    df = spark.createDataFrame([(*r, "x") for r in data], "page_id long, url string, html string, digest string")
    want = []
    for page, _, html in data:
        payload = (html or "").encode()
        same = [p for p, _, h in data if (h or "") == (html or "") and p is not None]
        to = max(same, default=None) if len(payload) >= 1000 else page
        revisit = to is not None and page != to
        want.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    assert rows(warc.roundtrip(df)) == sorted(want, key=repr)
    assert rows(warc.roundtrip(df.limit(0))) == []


def test_warc_members_are_entered_by_offset(tmp_path):
    import gzip
    import json

    archive = warc.Archive(f"file://{tmp_path}")
    payloads = [b"", b"a" * 5000, b"\r\n\r\nWARC/1.1\r\n"]
    for k, p in enumerate(payloads):
        archive.add(warc.record(k, b"http://x/", p, hashlib.sha1(p).hexdigest(), None))
    path, n, _ = archive.close()
    new, index, entries = warc.normalise_file(path)
    assert n == entries == 3
    data = open(new.removeprefix("file://"), "rb").read()
    assert gzip.decompress(data) == gzip.decompress(open(path.removeprefix("file://"), "rb").read())
    for line, p in zip(open(index.removeprefix("file://")), payloads, strict=True):
        e = json.loads(line)
        assert warc.parse(gzip.decompress(data[e["offset"] : e["offset"] + e["length"]]))["payload"] == p


# --- Toxicity -------------------------------------------------------------------------------------------


def test_marginals_are_those_of_all_paths():
    """Against the sum over all labellings, on texts with runs of plain tokens."""
    texts = [b"bad plain plain bad", b"plain plain plain", b"", b"plain bad worse plain plain bad plain plain"]
    found_words, found = toxicity.features(texts)
    keys = np.array([toxicity.features([w])[1][0, 0] for w in (b"bad", b"worse")])
    order = np.argsort(keys)
    model = toxicity.Model(keys[order], np.array([2.0, -0.7])[order], -1.0, np.array([[0.4, -0.3], [-0.6, 0.8]]))
    at, p = model.marginals(found, found_words.first)
    got = dict(zip(at.tolist(), p.tolist(), strict=True))
    _, score = model.emissions(found)
    for a, b in itertools.pairwise(found_words.first):
        total, on = 0.0, np.zeros(b - a)
        for labels in itertools.product((0, 1), repeat=b - a):
            w = np.exp(sum(model.transitions[x, y] for x, y in itertools.pairwise((0, *labels))) + sum(score[a + k] for k, y in enumerate(labels) if y))
            total += w
            on += w * np.array(labels)
        for k in range(b - a):
            if a + k in got:
                assert got[a + k] == pytest.approx(on[k] / total, abs=1e-9)
    assert len(got) >= 6


def chain_of(texts, rng):
    """A model with random weights for the words of ``texts`` that begin with w."""
    found_words, found = toxicity.features(texts)
    keys = np.unique(found[[found_words.word(k).startswith(b"w") for k in range(len(found))], 0])
    model = toxicity.Model(keys, rng.choice([-90.0, -2.0, -0.5, 0.5, 2.0, 90.0], len(keys)), -1.0, np.array([[0.7, -1.9], [-0.6, 1.8]]))
    return model, found, found_words.first


def test_marginals_of_long_texts_are_those_of_single_steps():
    """Against messages passed token by token, on texts longer and shorter than the blocks of the chain."""
    rng = np.random.default_rng(4)
    plain, marked = [b"x%d" % k for k in range(9)], [b"w%d" % k for k in range(40)]
    texts = [b" ".join(rng.choice(marked if k % 2 else plain + marked[:2], n)) for k, n in enumerate([900, 3, 1, 0, 2500, 40, 7, 1, 1, 300])]
    texts = [b"x1 x2 x3", *texts, b"", b"x1 w1 x1 x1 x1"]
    model, found, first = chain_of(texts, rng)
    at, p = model.marginals(found, first)
    has, score = model.emissions(found)
    step, want = np.exp(model.transitions), np.zeros(len(found))
    for a, b in itertools.pairwise(first.tolist()):
        own = np.stack((np.ones(b - a), np.exp(np.clip(score[a:b], -30, 30))), axis=1)
        ahead, back = np.empty((b - a, 2)), np.ones((b - a, 2))
        message = np.array([1.0, 0.0])
        for k in range(b - a):
            message = message @ step * own[k]
            ahead[k] = message = message / message.sum()
        for k in range(b - a - 2, -1, -1):
            back[k] = step @ (own[k + 1] * back[k + 1])
            back[k] /= back[k].sum()
        both = ahead * back
        want[a:b] = both[:, 1] / both.sum(axis=1)
    near = {k + d for a, b in itertools.pairwise(first.tolist()) for k in range(a, b) if has[k] for d in (-1, 0, 1)}
    assert at.tolist() == sorted(k for k in near if 0 <= k < len(found))
    assert np.abs(p - want[at]).max() < 1e-9 and (p > 0.5).any() and (p < 0.1).any()


def test_marginals_cost_the_same_in_one_long_text():
    """A long text cost as many steps as it has tokens, whatever ran beside it."""
    rng = np.random.default_rng(6)
    words = rng.choice([b"w%d" % k for k in range(40)], 100_000)
    took = []
    for texts in ([b" ".join(words[k : k + 50]) for k in range(0, len(words), 50)], [b" ".join(words)]):
        model, found, first = chain_of(texts, rng)
        start = time.process_time()
        at, _ = model.marginals(found, first)
        took.append(time.process_time() - start)
        assert len(at) == len(words)
    assert took[1] < 10 * took[0] + 0.2


def test_toxicity_learns_spans(spark):
    rng = np.random.default_rng(9)
    plain, bad = [f"p{k}" for k in range(300)], ["vile", "awful", "nasty"]
    data = []
    for k in range(600):
        text = list(rng.choice(plain, 60))
        toxic = k % 4 == 0
        if toxic:
            for at in rng.choice(60, 4, replace=False):
                text[at] = str(rng.choice(bad)).upper() if k % 8 == 0 else str(rng.choice(bad)) + "."
        data.append((k, " ".join(text), int(toxic)))
    docs = spark.createDataFrame([(d, t) for d, t, _ in data] + [(None, None), (1000, ""), (1001, "vile " * 4000)], "doc_id long, text string")
    labels = spark.createDataFrame([(d, 1, y) for d, _, y in data], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_documents(docs, labels).collect()}
    truth = {d: y for d, _, y in data}
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 5 == 0]
    assert all(got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d in truth)
    assert np.mean([got[d]["predicted"] == truth[d] for d in held]) > 0.97
    text = dict((d, t) for d, t, _ in data)
    spans = {text[d][s["start"] : s["end"]].lower() for d in truth for s in got[d]["spans"]}
    assert spans and spans <= set(bad)
    assert got[None]["score"] < 0.5 and got[1000]["score"] < 0.5 and got[1001]["predicted"] == 1
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and 1001 not in {r["doc_id"] for r in kept.collect()}


def test_toxicity_without_labels(spark, docs, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.score_documents(docs, labels).collect()} == {0.0}
    assert toxicity.score_documents(none, labels).count() == 0
    assert toxicity.keep_clean(docs, labels).count() == len(ROWS)
