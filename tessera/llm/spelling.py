"""Spelling variants: words one edit apart, found by automata over word halves.

Words are counted in the tasks that read the texts, and the counts are summed.  If two
words differ by one edit, one of the two halves of either lies unchanged in the other:
the first half at its start or the second at its end.  Each word's two halves are
patterns of Aho-Corasick automata, dealt into shards by the half and the word's length.
Every word is scanned by the automata of those shards where a word that is at most one
code point shorter or longer could have put a half of it (six at most); a match counts if
its offset and the two lengths fit, and then the distance is verified.

Halves that many words share (more than ``GROUP`` words and scans) would make many
candidates.  Their words go one level down instead: the half that is shared becomes
their context, and what remains of them is halved in its turn.  That is exact, since a
word that keeps the context has its edit in the rest; it ends, because a rest is half as
long at each level, and rests of one code point are few.

``form`` of a word is its most frequent near word if that is at least twice as frequent;
``root`` follows forms, of which counts double at each step, by pointer jumping.

Defined results: null and empty texts have no words; a null id is the empty text in
``<doc_id>:<word>``; repeated rows count as often as they occur; very long texts count
whole and very long words are words; no word of enough occurrences gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrow, scratch

#: Runs of ASCII letters and of U+00C0 to U+00FF, after A to Z are lower-cased.
RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A word loses a code point if this divides the CRC of ``<doc_id>:<word>``.
MODULUS = 97
#: Patterns and scans of one half, beyond which its words go one level down.
GROUP = 64
#: Patterns and scans of a shard, on average.
SHARD = 20_000
#: Words that a task counts before it passes the counts on.
HELD = 300_000


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH) -> DataFrame:
    """word, n: how often each word occurs in all texts."""
    schema = "word string, n long"

    def counted(total: Counter) -> pa.RecordBatch:
        words = [w for w in total if len(w) >= least_length]
        return pa.RecordBatch.from_arrays([pa.array(words, type=pa.string()), pa.array([total[w] for w in words], type=pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for part in arrow.sliced(batch):
                for d, raw in zip(part.column("id").to_pylist(), arrow.texts(part.column("text")), strict=True):
                    words = RUN.findall(raw.lower().decode())  # bytes.lower changes A to Z only
                    total.update(words)
                    start = zlib.crc32(f"{d or ''}:".encode())
                    for w in set(words):
                        crc = zlib.crc32(w.encode(), start)
                        if crc % MODULUS == 0:
                            n, at = words.count(w), crc % len(w)
                            total[w] -= n
                            total[w[:at] + w[at + 1 :]] += n
                if len(total) >= HELD:
                    yield counted(+total)
                    total = Counter()
        yield counted(+total)
        pa.default_memory_pool().release_unused()

    rows = docs.select(docs[doc_id].cast("string").alias("id"), docs[text].alias("text"))
    return rows.mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n"))


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point makes ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def _keys(batch: pa.RecordBatch) -> dict:
    """For each row (is_word or scan, context, rest, length) the halves under which it is looked up.

    A pattern has its two halves.  A scan has the halves that a pattern of each length
    within one of its own could have there: at its start, and at its end.
    """
    out: dict[str, list] = {c: [] for c in ("is_word", "context", "rest", "length", "side", "half", "word", "n")}
    for is_word, context, rest, length, word, n in zip(*(batch.column(c).to_pylist() for c in ("is_word", "context", "rest", "length", "word", "n")), strict=True):
        size = len(rest)
        # Below the first level a scan is of patterns of one length only.
        for own in (size,) if is_word else (size - 1, size, size + 1) if length is None else (length,):
            cut = own // 2
            for at_start in (True, False):
                long = cut if at_start else own - cut
                if 0 <= long <= size and own > 0:
                    for c, v in (("is_word", is_word), ("context", context), ("rest", rest), ("length", own), ("side", at_start), ("half", rest[:long] if at_start else rest[size - long :]), ("word", word), ("n", n)):
                        out[c].append(v)
    return out


_KEYED = "is_word boolean, context string, rest string, length int, side boolean, half string, word string, n long"
_KEY = ["context", "side", "half", "length"]


def _scanned(cols: dict, ranges: list[tuple[int, int]]) -> dict:
    """Pairs (word, near, near_n) of each shard: its automaton scans the rests of its scans."""
    out: dict[str, list] = {"word": [], "near": [], "near_n": []}
    for a, b in ranges:
        part = {c: v.slice(a, b - a).to_pylist() for c, v in cols.items()}
        patterns: dict[str, dict] = {}
        scans: dict[str, list] = {}
        for is_word, context, rest, length, side, half, word, n in zip(*(part[c] for c in ("is_word", "context", "rest", "length", "side", "half", "word", "n")), strict=True):
            if is_word:
                patterns.setdefault(half, {}).setdefault((context, side, length), []).append((rest, word, n))
            else:
                scans.setdefault(rest, {}).setdefault((context, side, length, len(half)), []).append(word)
        automaton = ahocorasick.Automaton()
        for half, of in patterns.items():
            if half:
                automaton.add_word(half, (len(half), of))
        automaton.make_automaton()
        for rest, asked in scans.items():
            found = list(automaton.iter(rest)) if len(automaton) else []
            if "" in patterns:  # rests of one code point have an empty first half
                found.append((-1, (0, patterns[""])))
            for (context, side, length, long), words in asked.items():
                for end, (size, of) in found:
                    fits = size == long and (end + 1 == size if side else end + 1 == len(rest) or size == 0)
                    for other, near, n in of.get((context, side, length), ()) if fits else ():
                        if one_edit(rest, other):
                            for word in words:
                                out["word"].append(word)
                                out["near"].append(near)
                                out["near_n"].append(n)
    return out


def near_pairs(counts: DataFrame) -> DataFrame:
    """word, near, near_n for each ordered pair of words of ``counts`` (word, n; a table on disk) one edit apart."""
    spark = counts.sparkSession
    of = counts.select(F.lit("").alias("context"), F.col("word").alias("rest"), F.lit(None).cast("int").alias("length"), "word", "n")
    rows = of.select(F.lit(True).alias("is_word"), "*").unionByName(of.select(F.lit(False).alias("is_word"), "*"))
    found = None
    while True:
        keyed = scratch.materialise(arrow.mapped(rows, _keys, _KEYED), "spelling-halves")
        by = keyed.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("size"), F.count_if("is_word").alias("n_words"))
        many = (F.col("size") > GROUP) & (F.col("length") > 2)
        by = by.filter("n_words > 0 AND size > n_words").select(*_KEY, many.alias("many"))
        keyed = keyed.join(by, _KEY)
        keyed = scratch.materialise(keyed, "spelling-dealt")
        light, heavy = keyed.filter("NOT many").drop("many"), keyed.filter("many").drop("many")
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-light.count() // SHARD))
        light = light.withColumn("shard", F.pmod(F.xxhash64(*_KEY), F.lit(shards)))
        pairs = scratch.materialise(arrow.grouped(light, ["shard"], _scanned, "word string, near string, near_n long"), "spelling-pairs")
        found = pairs if found is None else found.unionByName(pairs)
        if heavy.isEmpty():
            return found.distinct()
        # The shared half becomes the context; the other half remains.
        size = F.char_length("half")
        rest = F.when(F.col("side"), F.expr("substring(rest, char_length(half) + 1)")).otherwise(F.expr("substring(rest, 1, char_length(rest) - char_length(half))"))
        context = F.concat("context", F.when(F.col("side"), F.concat(F.lit("<"), "half")).otherwise(F.concat(F.lit(">"), "half")))
        rows = heavy.select("is_word", context.alias("context"), rest.alias("rest"), (F.col("length") - size).alias("length"), "word", "n")


def roots(forms: DataFrame) -> DataFrame:
    """word, root for each row of ``forms`` (word, form or null): the last of the chain of forms."""
    at = scratch.materialise(forms.select("word", F.col("form").alias("next")), "spelling-roots")
    while not at.filter("next IS NOT NULL").isEmpty():
        up = at.select(F.col("word").alias("of"), F.col("next").alias("after"))
        jumped = at.join(up, F.col("next") == F.col("of"), "left").select("word", F.col("next").alias("last"), "after")
        # A word whose next has no form is at its root; else its next jumps on.
        jumped = scratch.materialise(jumped, "spelling-jumps")
        if jumped.filter("after IS NOT NULL").isEmpty():
            return jumped.select("word", F.coalesce("last", "word").alias("root"))
        at = scratch.materialise(jumped.select("word", F.coalesce("after", "last").alias("next")), "spelling-roots")
    return at.select("word", F.col("word").alias("root"))


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n, n_near, form, form_n and root of each word of enough code points and occurrences."""
    counts = scratch.materialise(word_counts(docs, doc_id, text, least_length).filter(F.col("n") >= least_count), "spelling-words")
    near = near_pairs(counts).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("most"))
    words = counts.join(near, "word", "left")
    is_form = -F.col("most.less") >= 2 * F.col("n")
    words = words.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("most.form")).alias("form"), F.when(is_form, -F.col("most.less")).alias("form_n"))
    words = scratch.materialise(words, "spelling-forms")
    return words.join(roots(words), "word")
