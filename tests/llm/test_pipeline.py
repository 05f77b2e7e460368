"""The stages of the corpus pipeline on the smallest tables, each against brute force on its own input."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tessera.llm import line_dedup, mixing, simhash, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input of each stage and, at the end, the result."""
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
        seen.append(docs)
    return seen


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns(stages):
    assert [d.columns for d in stages[:5]] == [stages[0].columns] * 5


def test_toxic_documents_go(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity.score_documents(stages[0], labels)
    assert ids(stages[1]) == sorted(r["doc_id"] for r in scored.filter("predicted = 0").collect())


def test_repeated_lines_go(stages):
    rows = {r["doc_id"]: r["text"] for r in stages[1].collect()}
    holders = defaultdict(set)
    for d, t in rows.items():
        for x in t.encode().split(b"\n"):
            if len((k := line_dedup.line_key(x)).decode()) >= 20:
                holders[k].add(d)
    want = {}
    for d, t in rows.items():
        want[d] = b"\n".join(x for x in t.encode().split(b"\n") if len(h := holders.get(line_dedup.line_key(x), ())) < 3 or d == max(h)).decode()
    assert {r["doc_id"]: r["text"] for r in stages[2].collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect())


def test_one_of_each_group_stays(stages):
    sets = {r["doc_id"]: set(simhash.shingle_set(simhash.words_of((r["text"] or "").encode()), 5).tolist()) for r in stages[2].collect()}
    names, got = sorted(sets), set(ids(stages[3]))

    def firsts(similarity):
        label = {d: d for d in sets}
        near = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])]
        while any(label[a] != label[b] for a, b in near):
            for a, b in near:
                label[a] = label[b] = min(label[a], label[b])
        return {d for d in names if label[d] == d}

    assert firsts(0.8) <= got  # no document goes without a near one that stays
    assert len(names) - len(got) >= 0.8 * (len(names) - len(firsts(0.8)))


def test_copies_follow_the_mix(stages):
    want = Counter()
    for r in mixing.mix(stages[3]).collect():
        want[r["doc_id"]] += r["copies"]
    assert Counter(ids(stages[4])) == +want


def test_pieces_hold_all_tokens(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    library, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), Counter()
    for r in stages[4].collect():
        x = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for a in range(0, len(x), 2048):
            want[r["doc_id"], a, len(x[a : a + 2048]), zlib.crc32(x[a : a + 2048].tobytes())] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in stages[5].collect()) == want
    spans = defaultdict(list)
    for r in stages[5].collect():
        spans[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in spans.values():
        ends = np.cumsum([n for _, n in sorted(s)])
        assert [o for o, _ in sorted(s)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    key = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert Counter(tuple(r) for r in got.select(*key).collect()) == Counter(tuple(r) for r in stages[5].select(*key).collect())


@pytest.mark.parametrize("name", ["op5_mixing", "op8_line_dedup", "op9_exact_dedup", "op10_warc"])
def test_queries_match_sql(spark, name):
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    want = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*cols).collect())
