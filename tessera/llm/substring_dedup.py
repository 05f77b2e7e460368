"""Repeated passages: prefix-partitioned suffix trees over the words of all texts.

A window is ``WINDOW`` words of one text; a word goes if a window that covers it has
the words of a window that starts anywhere else.

*Sampling.*  Of the ``WINDOW - GRAM + 1`` word grams in a window the one with the least
hash is its anchor.  Equal windows have equal anchors in the same place, so only
suffixes that share an anchor gram can repeat: windows are kept as segments (the
windows of one text with the same anchor, about fourteen), and a gram that occurs once
drops its segment at once.  Where all segments of a gram are equal, all of their windows repeat.

*Prefix groups.*  What is left (segments of a gram that differ, at the ends of repeats)
is partitioned by that prefix of ``GRAM`` words.  A group of up to ``GROUP`` distinct
segments is a subtree in memory: the suffixes at its window starts are ranked by prefix
doubling until they are told apart down to ``WINDOW`` words, and the suffixes that remain together
are the leaves below one internal node of at least that depth, which is a repeat.  A
group that does not fit is split: suffixes that are equal in all ``WINDOW`` words become one leaf,
and the leaves take prefixes of ``DEEPER`` words, one length after the other.  A suffix alone
under its prefix is done, a leaf of several alone there is a repeat, a group of up to ``GROUP``
leaves is a subtree, and the rest takes the next length.  The repeated leaves are joined back
to their suffixes once.

Segments travel with their words only in mixed groups and once each, and texts are read
whole.  Words and grams are compared by 64-bit hashes.

Defined results: a null or empty text has no words; texts shorter than a window lose
nothing; repeated rows repeat each other's windows (rows are told apart by a 64-bit hash
of id and text, and equal ones lose the same); ids may be null or repeat; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrow, scratch, skew
from .words import Words, hashes, mixed, slices, spread

WINDOW = 35
GRAM = 8
GROUP = 256
#: Words of the longer prefixes of groups that do not fit; the last is a window.
DEEPER = (16, 24, 32, 35)

_Q = 0xD6E8FEB86659FD93
_Q_INVERSE = pow(_Q, -1, 1 << 64)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    if not _powers or len(_powers[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for k, q in enumerate((_Q, _Q_INVERSE)):
            steps = np.full(size, q, dtype=np.uint64)
            steps[0] = 1
            _powers[k : k + 1] = [np.cumprod(steps)]
    return _powers[0][:n], _powers[1][:n]


def _grams(h: np.ndarray) -> np.ndarray:
    """The hash of the GRAM words from each word on, over the end as well (not to be used there)."""
    step = 1
    while step < GRAM:
        h = mixed(h, np.append(h[step:], h[:step]))
        step *= 2
    return h


class Ranges:
    """Hashes of ranges of word hashes."""

    def __init__(self, h: np.ndarray):
        power, self.inverse = _power_tables(len(h) + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * power[:-1])))

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.inverse[start]


def segments(words: Words) -> dict[str, np.ndarray]:
    """The segments of all texts: text, lo (first window, a word of the text), n (windows), gram, seg (hash of all)."""
    h = hashes(words.data, words.starts, words.ends)
    size = np.diff(words.first)
    windows = np.maximum(size - WINDOW + 1, 0)
    total = int(windows.sum())
    if not total:
        return {k: np.zeros(0, np.int64) for k in ("text", "lo", "n", "gram", "seg", "at")} | {"h": h}
    text = np.repeat(np.arange(len(size)), windows)
    start = spread(words.first[:-1], windows)
    gram = _grams(h)
    span = WINDOW - GRAM + 1
    least = np.lib.stride_tricks.sliding_window_view(gram, span)[: len(gram)]
    anchor = np.empty(total, dtype=np.int64)
    for a in range(0, total, 1 << 18):
        s = start[a : a + (1 << 18)]
        anchor[a : a + (1 << 18)] = s + np.argmin(least[s], axis=1)
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))))
    n = np.diff(np.append(new, total))
    lo, place = start[new], anchor[new]
    seg = Ranges(h).of(lo, lo + n + WINDOW - 1)
    seg = mixed(seg, (n * 64 + place - lo).astype(np.uint64))
    return {"text": text[new], "lo": lo - words.first[text[new]], "n": n, "gram": gram[place], "seg": seg, "at": lo, "h": h}


def _anchor_rows(batch: pa.RecordBatch) -> dict:
    texts, rids, out = arrow.texts(batch.column("text")), batch.column("rid").to_numpy(), []
    for a, b in slices(texts):
        s = segments(Words(texts[a:b]))
        out.append((s["gram"].view(np.int64), s["seg"].view(np.int64), rids[a:b][s["text"]], s["lo"].astype(np.int32), s["n"].astype(np.int32)))
    return dict(zip(("gram", "seg", "rid", "lo", "n"), map(np.concatenate, zip(*out, strict=True)), strict=True))


def _segment_words(batch: pa.RecordBatch) -> dict:
    """Of the wanted places of each text the segment's words, each distinct segment once a batch."""
    texts = arrow.texts(batch.column("text"))
    wanted = [np.array(x, dtype=np.int64) for x in batch.column("places").to_pylist()]
    seen: dict[tuple[int, int], list] = {}
    for a, b in slices(texts):
        s = segments(Words(texts[a:b]))
        base = np.searchsorted(s["text"], np.arange(b - a + 1))
        for i in range(b - a):
            own = np.arange(base[i], base[i + 1])
            for k in own[np.isin(s["lo"][own], wanted[a + i])]:
                key = (int(s["gram"][k]), int(s["seg"][k]))
                if key in seen:
                    seen[key][0] += 1
                else:
                    at, n = int(s["at"][k]), int(s["n"][k])
                    seen[key] = [1, n, s["h"][at : at + n + WINDOW - 1].tobytes()]
    keys = np.array(list(seen), dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return {"gram": keys[:, 0], "seg": keys[:, 1], "copies": [v[0] for v in seen.values()], "n": pa.array([v[1] for v in seen.values()], pa.int32()), "words": pa.array([v[2] for v in seen.values()], pa.binary())}


def repeats_in(groups: list[int], words: list[np.ndarray], n: list[int], copies: list[int]) -> list[int]:
    """For each segment a mask of its windows that occur again within its group.

    All suffixes of all segments are ranked together; the group is their first
    symbol, so suffixes of two groups never share a node.
    """
    sizes = np.array([len(w) for w in words])
    at = np.cumsum(sizes) - sizes
    _, symbol = np.unique(np.concatenate(words), return_inverse=True)
    rank, depth = symbol.astype(np.int64), 1

    def joined(a: np.ndarray, step: int) -> np.ndarray:
        """Ranks of pairs of the node here and the node ``step`` words on."""
        b = np.append(a[step:], np.zeros(min(step, len(a)), dtype=np.int64))[: len(a)]
        return np.unique(a * (int(a.max()) + 1) + b, return_inverse=True)[1].astype(np.int64)

    while 2 * depth <= WINDOW:
        rank, depth = joined(rank, depth), 2 * depth
    if depth < WINDOW:
        rank = joined(rank, WINDOW - depth)
    windows = np.array(n)
    start = spread(at, windows)
    owner = np.repeat(np.arange(len(words)), windows)
    group = np.unique(np.array(groups, dtype=np.int64), return_inverse=True)[1]
    node = rank[start] * (int(group.max()) + 1) + group[owner]
    _, leaf, count = np.unique(node, return_inverse=True, return_counts=True)
    again = (count[leaf] > 1) | (np.array(copies)[owner] > 1)
    bit = np.arange(len(start)) - np.repeat(np.cumsum(windows) - windows, windows)
    masks = np.zeros(len(words), dtype=np.int64)
    np.bitwise_or.at(masks, owner[again], np.int64(1) << bit[again])
    return masks.tolist()


def _subtrees(batch: pa.RecordBatch) -> dict:
    grams, lists = batch.column("gram").to_pylist(), batch.column("segs").to_pylist()
    segs = [(g, s) for g, x in zip(grams, lists, strict=True) for s in x]
    masks = repeats_in([g for g, _ in segs], [np.frombuffer(s["words"], np.uint64) for _, s in segs], [s["n"] for _, s in segs], [s["copies"] for _, s in segs])
    return {"gram": [g for g, _ in segs], "seg": [s["seg"] for _, s in segs], "copies": [s["copies"] for _, s in segs], "mask": masks}


def _suffixes(batch: pa.RecordBatch) -> dict:
    """Each suffix of a segment: its WINDOW words, which of the segment's windows it is, and the hash of each of its ``DEEPER`` prefixes."""
    n = batch.column("n").to_numpy().astype(np.int64)
    words = [np.frombuffer(w, np.uint64) for w in batch.column("words").to_pylist()]
    owner = np.repeat(np.arange(len(n)), n)
    bit = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    bodies = [words[k][b : b + WINDOW].tobytes() for k, b in zip(owner, bit, strict=True)]
    ranges, start = Ranges(np.frombuffer(b"".join(bodies), np.uint64)), np.arange(len(bodies)) * WINDOW
    keys = {f"k{size}": ranges.of(start, start + size).view(np.int64) for size in DEEPER}
    return {c: batch.column(c).take(pa.array(owner)) for c in ("gram", "seg", "copies")} | {"bit": bit, "body": bodies} | keys


def _prefix_subtrees(batch: pa.RecordBatch) -> dict:
    """The leaves of subtrees below longer prefixes that occur again."""
    at = np.cumsum([0, *[len(x) for x in batch.column("members")]])
    flat = batch.column("members").flatten()
    words, copies = [np.frombuffer(x, np.uint64) for x in flat.field("body").to_pylist()], flat.field("copies").to_numpy()
    groups = np.repeat(np.arange(batch.num_rows), np.diff(at))
    again = np.array(repeats_in(groups.tolist(), words, [1] * len(words), copies.tolist()) if words else [], dtype=np.int64) > 0
    hit = pa.array(np.flatnonzero(again))
    return {"gram": batch.column("gram").take(pa.array(groups)).take(hit)} | {c: flat.field(c).take(hit) for c in ("leaf", "places")}


def deeper_repeats(segs: DataFrame) -> DataFrame:
    """gram, seg, copies, bit: the windows of ``segs`` (of groups that do not fit) that occur again.

    Equal suffixes are one leaf (with how many ``places`` there are in the segments and how
    many ``copies`` in the texts), so a passage of any number of copies goes down the tree once.
    """
    keys = ", ".join(f"k{size} long" for size in DEEPER)
    suffixes = scratch.materialise(arrow.mapped(segs, _suffixes, f"gram long, seg long, copies long, bit int, body binary, {keys}"), "suffixes")
    suffixes = suffixes.withColumnRenamed(f"k{WINDOW}", "leaf")
    key_of = {size: ["gram", f"k{size}" if size < WINDOW else "leaf"] for size in DEEPER}
    shared = [F.first(c).alias(c) for c in (*[key[1] for key in key_of.values() if key[1] != "leaf"], "body")]
    rest = scratch.materialise(suffixes.groupBy("gram", "leaf").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("places"), *shared), "leaves")
    found = []
    for size, key in key_of.items():
        groups = rest.groupBy(*key).agg(F.count(F.lit(1)).alias("leaves"), F.sum("copies").alias("starts"), F.sum("places").alias("places"), F.min("leaf").alias("only")).filter("starts > 1")
        groups = scratch.materialise(groups, "prefix-groups")
        found.append(groups.filter("leaves = 1").select("gram", F.col("only").alias("leaf"), "places"))
        if size == WINDOW:
            break  # distinct leaves are told apart here
        split = groups.filter("leaves > 1").select(*key, "leaves")
        below = scratch.materialise(skew.join_by_group(rest, split, key, "leaves", rest.count()), "prefix-members")
        trees = below.filter(F.col("leaves") <= GROUP).groupBy(*key).agg(F.collect_list(F.struct("leaf", "copies", "places", "body")).alias("members"))
        found.append(arrow.mapped(trees.select("gram", "members"), _prefix_subtrees, "gram long, leaf long, places long"))
        rest = below.filter(F.col("leaves") > GROUP).select(*rest.columns)
    hits = scratch.materialise(reduce(DataFrame.unionByName, found), "repeated-leaves")
    return skew.join_by_group(suffixes, hits, ["gram", "leaf"], "places", suffixes.count()).select("gram", "seg", "copies", "bit")


def _strip(batch: pa.RecordBatch, keep_text: bool) -> dict:
    out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept": []}
    for text, gone in zip(arrow.texts(batch.column("text")), batch.column("gone").to_pylist(), strict=True):
        words = text.split()
        n = len(words)
        if gone:
            edge = np.zeros(n + 1, dtype=np.int64)
            for x in gone:
                windows = x["lo"] + np.flatnonzero(np.array([x["mask"] >> k & 1 for k in range(x["n"])]))
                np.add.at(edge, windows, 1)
                np.add.at(edge, windows + WINDOW, -1)
            words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
        kept = b" ".join(words)
        out["n_words"].append(n)
        out["n_removed"].append(n - len(words))
        out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        out["kept"].append(kept if keep_text else None)
    return out | {"doc_id": batch.column("doc_id"), "kept": pa.array(out["kept"], pa.binary()).cast(pa.string())}


def repeated_windows(rows: DataFrame) -> DataFrame:
    """rid, lo, n, mask (of n windows from word lo on, those that repeat) out of ``rows`` (rid, text)."""
    anchors = scratch.materialise(arrow.mapped(rows.select("rid", "text"), _anchor_rows, "gram long, seg long, rid long, lo int, n int"), "anchors")
    total = anchors.count()
    grams = anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("hits"), (F.min("seg") != F.max("seg")).alias("mixed")).filter("hits > 1")
    grams = scratch.materialise(grams, "repeated-grams")
    found = scratch.materialise(skew.join_by_group(anchors, grams, ["gram"], "hits", total).drop("hits"), "candidates", ["mixed"])
    plain = found.filter(~F.col("mixed")).select("rid", "lo", "n", (F.call_function("shiftleft", F.lit(1).cast("long"), F.col("n")) - 1).alias("mask"))
    open_ = found.filter("mixed")

    places = open_.groupBy("rid").agg(F.collect_set("lo").alias("places"))
    texts = rows.join(places, "rid").select("rid", "text", "places")
    segs = arrow.mapped(texts, _segment_words, "gram long, seg long, copies long, n int, words binary")
    segs = segs.groupBy("gram", "seg").agg(F.sum("copies").alias("copies"), F.first("n").alias("n"), F.first("words").alias("words"))
    segs = scratch.materialise(segs, "segments")
    large = scratch.materialise(segs.groupBy("gram").agg(F.count(F.lit(1)).alias("segs")).filter(F.col("segs") > GROUP), "large-groups")
    some = not large.isEmpty()
    large = skew.small(large.select("gram"))
    fits = segs.join(large, "gram", "left_anti") if some else segs
    trees = fits.groupBy("gram").agg(F.collect_list(F.struct("seg", "copies", "n", "words")).alias("segs"))
    masks = arrow.mapped(trees, _subtrees, "gram long, seg long, copies long, mask long").filter("mask <> 0")
    if some:
        hits = deeper_repeats(segs.join(large, "gram", "left_semi").select("gram", "seg", "copies", "n", "words"))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
        masks = masks.unionByName(hits.groupBy("gram", "seg").agg(F.max("copies").alias("copies"), F.bit_or(bit).alias("mask")))
    masks = scratch.materialise(masks, "masks")
    told = skew.join_by_group(open_.select("gram", "seg", "rid", "lo", "n"), masks, ["gram", "seg"], "copies", total)
    return plain.unionByName(told.select("rid", "lo", "n", "mask"))


def strip_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (the words that stay, joined by spaces; or null) of each row."""
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"), F.xxhash64(docs[doc_id], docs[text]).alias("rid"))
    gone = repeated_windows(rows).groupBy("rid").agg(F.collect_set(F.struct("lo", "n", "mask")).alias("gone"))
    schema = arrow.with_column("doc_id", docs.schema[doc_id].dataType, "n_words long, n_removed long, kept_sha256 string, kept string")
    return arrow.mapped(rows.join(gone, "rid", "left").select("doc_id", "text", "gone"), partial(_strip, keep_text=keep_text), schema)
