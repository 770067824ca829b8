"""Repeated passages from enhanced suffix arrays: all maximal repeats of at least ``LENGTH`` words, with all their occurrences.

Words are runs without ASCII white space, compared as they stand. Sorting every suffix of a corpus in one array
isn't needed: an interval of the suffix array whose common prefix is LENGTH words or longer lies among the suffixes
that agree in a content-defined anchor. So:

1. Every start p of LENGTH words has one anchor, the rightmost least hash among the 25-word runs beginning in the window
   (``GRAM`` words, LENGTH - GRAM + 1 runs). Equal passages have equal anchors. Anchors are about one in
   13 words. One shuffle by anchor hash finds those that recur, and those where the words before the starts they own differ:
   only there can a repeat begin that can't be extended to the left.
2. For those anchors, the text from the anchor on (as far as it can recur, without a limit) is sent to the anchor's group. There the suffixes are sorted, the
   longest common prefixes taken, and a stack scan of them builds the tree of common-prefix
   intervals. An interval whose occurrences differ in the word to the left is a maximal repeat
   group; another passes its occurrences up.

Result: (group_id, parent_id, n_words, n_occurrences, doc_id, start_word, copied_words, text_hash). A group's occurrences are
its own rows and those of the groups below it (parent_id); each occurrence is listed once, in the
longest group that it belongs to, so that the result grows with the text, not with the
square of a family of copies. (A group all of whose occurrences are in groups below has one row, for its first
occurrence.) copied_words: how many words from start_word on also stand at an earlier (doc_id, text_hash, start_word); 0 for a
first occurrence. Nothing is capped.

Where a stretch repeats with a period of 25 words or less, only its first anchors, up to those that own the starts of its first period,
and its last are used. What lies between repeats the first period: the stretch is listed as a group of its own,
of two occurrences a period apart, so that copied_words covers all of it but the first period. Of the further groups of
occurrences that overlap one another in that way, those between aren't listed.
Words after an anchor are compared by 32 bits of their hash, anchors by 64 bits.

Rows without doc_id are left out. Null, empty and short texts (under LENGTH words) have no repeats. Rows equal in
doc_id and text count as one document; rows that repeat a doc_id with another text are documents of their own, told apart by text_hash. Ties go to the smaller
(doc_id, text_hash, start_word). An empty table gives an empty result. Columns besides doc_id and text don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textops as T
from .common import keyed, lean, written

LENGTH, GRAM = 50, 25
BARRIER = 1 << 62  # no barriers: groups are maximal; a smaller one bounds the text that is sent, and cuts groups into chains
U = np.uint64


def _all_anchors(w: T.Words, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word number of the anchor, its hash, first and last start that it owns), in order."""
    none = np.zeros(0, np.int64)
    g = T.gram_hashes(w.hash, gram)
    window = length - gram + 1
    if len(w.hash) < length:
        return none, np.zeros(0, U), none, none
    best, arg, span = g, np.arange(len(g)), 1
    while span < window:
        by = min(span, window - span)
        right = best[by:] <= best[: len(best) - by]
        best, arg = np.where(right, best[by:], best[: len(best) - by]), np.where(right, arg[by:], arg[: len(arg) - by])
        span += by
    starts = np.flatnonzero(w.last[: len(best)] >= np.arange(len(best)) + length)
    if len(starts) == 0:
        return none, np.zeros(0, U), none, none
    own = arg[starts]
    cut = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    at, low, high = own[cut], starts[cut], starts[np.r_[cut[1:], len(starts)] - 1]
    return at, g[at], low, high


def _links(w: T.Words, at: np.ndarray, h: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each anchor but the last: whether it and the next lie in a stretch with the period of their distance; the distance; whether the stretch goes on from the link before."""
    step = at[1:] - at[:-1]
    link = (h[1:] == h[:-1]) & (step <= min(gram, length - gram + 1)) & (w.last[at[1:]] == w.last[at[:-1]])
    return link, step, np.r_[False, link[1:] & link[:-1] & (step[1:] == step[:-1])][: len(link)]


def anchors_of(w: T.Words, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word number of the anchor, its hash, first and last start that it owns, whether starts before them were left out), in order.
    Left out are starts in a periodic stretch, a period or more after its first word, whose passages end in it: ``stretches`` has those."""
    at, h, low, high = _all_anchors(w, length, gram)
    if len(at) == 0:
        return at, h, low, high, np.zeros(0, bool)
    link, step, on = _links(w, at, h, length, gram)
    begin = np.maximum.accumulate(np.where(on, 0, np.arange(len(link)))) if len(link) else np.zeros(0, np.int64)
    inside = np.flatnonzero(on)  # anchors with a link on both sides
    keep = np.ones(len(at), bool)
    keep[inside] = at[inside] - at[begin[inside]] <= length - gram + step[inside] - 1
    left_out = np.r_[False, ~keep[:-1]]
    return at[keep], h[keep], low[keep], high[keep], left_out[keep]


def stretches(w: T.Words, length: int = LENGTH, gram: int = GRAM) -> list[tuple[int, int, int]]:
    """(first word, end, period) of the longest stretches with a period of no more than ``gram`` words that hold two starts a period apart."""
    at, h, _, _ = _all_anchors(w, length, gram)
    if len(at) < 2:
        return []
    link, step, on = _links(w, at, h, length, gram)
    if not link.any():
        return []
    doc, ends, out = w.doc, w.last, []
    for a in np.flatnonzero(link & ~on).tolist():
        z = a
        while z + 1 < len(link) and on[z + 1]:
            z += 1
        k, s, e = int(step[a]), int(at[a]), int(at[z + 1]) + gram
        first, last = int(w.first[doc[s]]), int(ends[s])
        while s > first and w.hash[s - 1] == w.hash[s - 1 + k]:
            s -= 1
        while e < last and w.hash[e] == w.hash[e - k]:
            e += 1
        if e - s - k >= length:
            out.append((s, e, k))
    return out


def _stretch_rows(length: int, gram: int):
    """Result rows of periodic stretches: each is a group of two occurrences a period apart, which overlap."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for w in T.each_words(b.column(1), normal=False):
                for s, e, k in stretches(w, length, gram):
                    d = int(np.searchsorted(w.first, s, "right")) - 1
                    doc, th, at, n = b.column(0)[w.lo + d].as_py(), b.column(2)[w.lo + d].as_py(), s - int(w.first[d]), e - s - k
                    group = xxhash.xxh64_intdigest(f"{doc} {th} {at} {e - s} {k}") >> 1
                    out += [(group, None, n, 2, doc, at, 0, th), (group, None, n, 2, doc, at + k, n, th)]
            if out:
                yield _batch(out)

    return run


def _anchor_rows(length: int, gram: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in T.each_words(b.column(1), normal=False):
                at, h, low, high, left_out = anchors_of(w, length, gram)
                if len(at) == 0:
                    continue
                doc = w.doc
                ids, texts = (b.column(c)[w.lo : w.hi].to_numpy()[doc[at]] for c in (0, 2))
                first = w.first[:-1][doc[at]]
                s = np.zeros(len(w.hash) + 1, U)
                np.cumsum((w.hash | U(1)) * T._G.upto(len(w.hash)), out=s[1:])
                begin = np.maximum(low - 1, first)
                left = T.mix((s[at] - s[begin]) * T._GI.upto(len(w.hash))[begin] + (at - low).astype(U))
                edge = (low == first) | left_out
                alone = T.mix(T.mix(ids.astype(np.int64).view(U) * U(0x9E3779B97F4A7C15) + texts.view(U)) + (at - first).astype(U))
                left = np.where(edge, alone, left)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(left.view(np.int64)), pa.array(ids), pa.array(texts), pa.array((at - first).astype(np.int32))], ["anchor", "before", "doc_id", "th", "at"])

    return run


def _suffix_rows(length: int, gram: int, barrier: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = b.column(3)
            values, offsets = marks.flatten().to_numpy(), np.r_[0, np.cumsum(np.diff(marks.offsets.to_numpy()))]
            for w in T.each_words(b.column(1), normal=False):
                at, h, low, high, left_out = anchors_of(w, length, gram)
                if len(at) == 0:
                    continue
                coded = (w.hash >> U(32)).astype(">u4").tobytes()
                bounds = np.searchsorted(at, w.first)
                out: list[list] = [[] for _ in range(8)]
                for d in range(w.hi - w.lo):
                    lo, hi = bounds[d], bounds[d + 1]
                    if lo == hi:
                        continue
                    base, end = int(w.first[d]), int(w.first[d + 1])
                    mark = values[offsets[w.lo + d] : offsets[w.lo + d + 1]]
                    place, place_at = at[lo:hi] - base, at[lo:hi]
                    recurs = np.isin(place, mark >> 1)
                    heads = recurs & np.isin(place, mark[(mark & 1) == 1] >> 1)
                    n = hi - lo
                    nearest = end  # where the text after this anchor ends
                    is_barrier = (h[lo:hi] % U(barrier)) == 0
                    ends = np.empty(n, np.int64)
                    wall = end
                    for k in range(n - 1, -1, -1):
                        ends[k] = min(nearest, wall)
                        if not recurs[k]:
                            nearest = min(end, int(low[lo + k]) + length)
                        if is_barrier[k]:
                            wall = min(end, int(place_at[k]) + length + gram + 1)
                    for k in np.flatnonzero(heads).tolist():
                        a, lw = int(place_at[k]), int(low[lo + k])
                        first = lw if left_out[lo + k] else max(lw - 1, base)
                        back = np.frombuffer(coded[4 * first : 4 * a], ">u4")[::-1].tobytes()
                        for column, x in zip(out, (int(h[lo + k].view(np.int64)), b.column(0)[w.lo + d].as_py(), b.column(2)[w.lo + d].as_py(), a - base, a - int(high[lo + k]), a - lw, back, coded[4 * a : 4 * int(ends[k])])):
                            column.append(x)
                if out[0]:
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(out[j], pa.int64()) for j in (0, 1, 2)), *(pa.array(out[j], pa.int32()) for j in (3, 4, 5)), pa.array(out[6], pa.binary()), pa.array(out[7], pa.binary())],
                        ["anchor", "doc_id", "th", "at", "t_low", "t_high", "left", "right"],
                    )

    return run


def common_words(a: bytes, b: bytes) -> int:
    if a == b:
        return len(a) // 4
    n = min(len(a), len(b)) // 4
    x, y = np.frombuffer(a, np.uint32, n), np.frombuffer(b, np.uint32, n)
    unequal = np.flatnonzero(x != y)
    return int(unequal[0]) if len(unequal) else n


DIVERSE = object()


def interval_tree(lcp: list[int], before: list, first: list, least: int) -> tuple[list[tuple], list[int], list[int], list[tuple[int, int]]]:
    """Common-prefix intervals of n sorted suffixes. lcp[i] is that of suffixes i and i+1, before[i] what precedes
    suffix i (None: nothing that equals another), first[i] its rank among the occurrences. Intervals of fewer than ``least`` are left out.
    Returns groups (length, occurrences, first member), the group of each suffix (-1: none), how much of it an earlier
    one has, and (group, parent)."""
    n = len(before)
    groups: list[tuple] = []
    of, copied, parents = [-1] * n, [0] * n, []
    # A node: length, what precedes (or DIVERSE), its first member, members not yet in a group, groups not yet with a parent, number of members
    stack: list[list] = []

    def leaf(i: int) -> list:
        return [None, DIVERSE if before[i] is None else before[i], i, [i], [], 1, [i]]

    def close(node: list) -> None:
        if node[0] >= least and node[1] is DIVERSE:
            g = len(groups)
            groups.append((node[0], node[5], node[2]))
            for i in node[3]:
                of[i] = g
            parents.extend((child, g) for child in node[4])
            for i in node[6]:
                if i != node[2]:
                    copied[i] = node[0]
            node[3], node[4], node[6] = [], [g], [node[2]]

    def join(into: list, node: list) -> None:
        if into[1] is not DIVERSE and (node[1] is DIVERSE or node[1] != into[1]):
            into[1] = DIVERSE
        if first[node[2]] < first[into[2]]:
            into[2] = node[2]
        into[3] += node[3]
        into[4] += node[4]
        into[5] += node[5]
        into[6] += node[6]

    last = leaf(0) if n else None
    for i in range(n):
        length = lcp[i] if i < n - 1 else -1
        while stack and stack[-1][0] > length:
            top = stack.pop()
            join(top, last)
            close(top)
            last = top
        if i == n - 1:
            break
        if stack and stack[-1][0] == length:
            join(stack[-1], last)
        elif length >= least:
            node = [length, last[1], last[2], last[3], last[4], last[5], last[6]]
            stack.append(node)
        last = leaf(i + 1)
    return groups, of, copied, parents


def repeats_at_anchor(anchor: int, rows: list[tuple], length: int = LENGTH, barrier: int = BARRIER) -> list[tuple]:
    """Result rows from one anchor's suffixes: rows are ((doc_id, text_hash), at, t_low, t_high, left, right)."""
    rows = sorted({(r[0], r[1]): r for r in rows}.values(), key=lambda r: (r[5], r[0], r[1]))
    n = len(rows)
    if n < 2:
        return []
    lcp = [common_words(rows[i][5], rows[i + 1][5]) for i in range(n - 1)]
    lefts = sorted(r[4] for r in rows)
    depths = {common_words(lefts[i], lefts[i + 1]) for i in range(n - 1)}
    walled = anchor % barrier == 0
    if walled:
        depths |= {r[2] for r in rows}
    out = []
    for t in sorted(depths):
        classes: dict[bytes, list[int]] = {}
        for i, r in enumerate(rows):
            if r[2] <= t <= r[3] and len(r[4]) >= 4 * t:
                classes.setdefault(r[4][: 4 * t], []).append(i)
        for back, members in classes.items():
            if len(members) < 2:
                continue
            if len(members) == n:
                between = lcp
            else:
                between = [min(lcp[a:b]) for a, b in zip(members, members[1:])]
            before = [rows[i][4][4 * t : 4 * t + 4] or None for i in members]
            if walled:
                before = [x if t not in (rows[i][2],) else None for x, i in zip(before, members)]
            rank = [(rows[i][0], rows[i][1]) for i in members]
            groups, of, copied, parents = interval_tree(between, before, rank, max(length - t, 1))
            if not groups:
                continue
            ids = [xxhash.xxh64_intdigest(back + b"|" + rows[members[f]][5][: 4 * size]) >> 1 for size, _, f in groups]
            above = dict(parents)
            shown = [False] * len(groups)

            def row(g: int, m: int, had: int) -> tuple:
                size, count, _ = groups[g]
                r = rows[members[m]]
                return ids[g], ids[above[g]] if g in above else None, t + size, count, r[0][0], r[1] - t, had and t + had, r[0][1]

            for m, g in enumerate(of):
                if g >= 0:
                    shown[g] = True
                    out.append(row(g, m, copied[m]))
            out += [row(g, groups[g][2], copied[groups[g][2]]) for g, s in enumerate(shown) if not s]
    return out


NAMES = ["group_id", "parent_id", "n_words", "n_occurrences", "doc_id", "start_word", "copied_words", "text_hash"]
KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), KINDS)], NAMES)


def _groups(length: int, barrier: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now, ready = [], None, []
        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            for anchor, doc, th, *r in zip(*columns):
                if anchor != now:
                    if len(held) > 1:
                        ready += repeats_at_anchor(now, held, length, barrier)
                        if len(ready) > 20_000:
                            yield _batch(ready)
                            ready = []
                    held, now = [], anchor
                held.append(((doc, th), *r))
        if len(held) > 1:
            ready += repeats_at_anchor(now, held, length, barrier)
        if ready:
            yield _batch(ready)

    return run


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, barrier: int = BARRIER) -> DataFrame:
    """Maximal repeats of docs (doc_id, text); see the module for the result."""
    if not 0 < gram <= length:
        raise ValueError("gram must be positive, and length no less")
    docs = keyed(docs).withColumn("th", F.xxhash64("text"))
    by_anchor = Window.partitionBy("anchor")
    anchors = docs.mapInArrow(_anchor_rows(length, gram), "anchor long, before long, doc_id long, th long, at int")
    marks = (
        anchors.withColumn("n", F.count("*").over(by_anchor))
        .withColumn("low", F.min("before").over(by_anchor))
        .withColumn("high", F.max("before").over(by_anchor))
        .where("n > 1")
        .groupBy("doc_id", "th")
        .agg(F.collect_list(F.col("at") * 2 + F.when((F.col("low") < F.col("high")) | (F.pmod("anchor", F.lit(barrier)) == 0), 1).otherwise(0)).alias("marks"))
        .where(F.exists("marks", lambda x: x % 2 == 1))
    )
    suffixes = docs.join(marks, ["doc_id", "th"]).select("doc_id", "text", "th", "marks").mapInArrow(_suffix_rows(length, gram, barrier), "anchor long, doc_id long, th long, at int, t_low int, t_high int, left binary, right binary")
    result = "group_id long, parent_id long, n_words int, n_occurrences int, doc_id long, start_word int, copied_words int, text_hash long"
    groups = suffixes.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_groups(length, barrier), result)
    return groups.unionByName(docs.mapInArrow(_stretch_rows(length, gram), result))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs, with all their columns, without the passages that also stand earlier (in another document, or in the same one); n_chars is set
    anew where it exists. Documents of which nothing remains go. White space around a passage that goes is reduced to one space. Rows without doc_id stay as they are, and
    rows equal in doc_id and text are cut alike. What is cut from a row is what was found in its own text."""
    found = repeats(docs, length).where("copied_words > 0").groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start_word", "copied_words")).alias("cuts"))
    found = written(found, "cuts")
    names = docs.columns
    row = F.struct(*(F.col(f"`{c}`") for c in names)).alias("row")  # so that no other column clashes
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), row)
    have = rows.where("doc_id is not null").join(found, ["doc_id", "text_hash"], "left").select("row.*", F.col("cuts").alias("cuts of the row"))
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cuts = b.column(len(names))
            cut_at = np.flatnonzero(cuts.is_valid().to_numpy(zero_copy_only=False))
            if len(cut_at) == 0:
                yield b.select(names)
                continue
            new = {}
            for i in cut_at.tolist():
                text = b.column(at)[i].as_py() or ""
                raw = np.frombuffer(text.encode(), np.uint8)
                w = T.words_of(raw, np.array([0, len(raw)]), normal=False)
                gone = np.zeros(len(w.hash) + 1, np.int32)
                for c in cuts[i].as_py():
                    gone[c["start_word"]] += 1
                    gone[min(c["start_word"] + c["copied_words"], len(w.hash))] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                edge = np.flatnonzero(np.diff(np.r_[True, gone, True].astype(np.int8)))
                new[i] = " ".join(raw[w.start[a] : w.end[z - 1]].tobytes().decode() for a, z in zip(edge[::2].tolist(), edge[1::2].tolist()))
            texts = b.column(at).to_pylist()
            columns = list(b.columns[: len(names)])
            for i, t in new.items():
                texts[i] = t
            columns[at] = pa.array(texts, columns[at].type)
            if chars is not None:
                counts = columns[chars].to_pylist()
                for i, t in new.items():
                    counts[i] = len(t)
                columns[chars] = pa.array(counts, columns[chars].type)
            stays = np.ones(b.num_rows, bool)
            stays[[i for i, t in new.items() if not t]] = False
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(stays))

    return have.mapInArrow(run, docs.schema).union(docs.where("doc_id is null"))
