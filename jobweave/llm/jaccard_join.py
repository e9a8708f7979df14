"""Jaccard self-join of shingle sets on group counts: a routed R-tree of count vectors.

The hashed shingles of a document are dealt into groups; the group counts are a point. Two sets with sizes a and b
overlap in at most the sum of their smaller group counts, so a Jaccard similarity of ``num / den`` bounds how far their points
may lie apart (in the sum of coordinate differences). The groups are cut into slabs, one more than that distance: points of a
pair agree in one slab altogether. That slab routes a point to its partition of the index.

1. Equal sets are folded by a 128-bit digest; the least id stands for them.
2. A linked document shares ``num / den`` of its set with another one. Counting in how many documents each shingle occurs (40 bits of it
   within a range) therefore leaves out all documents with too few shingles that occur twice; a bitmap of fixed size tells the tasks which stay.
3. A document that stays sends one short record per slab. Documents that agree in a slab of three or more shingles are candidates; slabs of
   fewer carry a 64-group point, and a packed R-tree over these finds the candidates.
4. Candidates are gathered by connected component. Each component holds an R-tree of fine group counts; node against
   node and then point against point the overlap is bounded by summed minima, and what survives is verified on the whole sets.
   Components beyond ``TILE`` shingles are cut into tiles, and each pair of tiles is a task of its own.
5. Only links that join two parts are kept, and their components are the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import (
    LOWER, NULL_ID, SLICE_BYTES, bitmap, filled, ids, is_set, keyed, mix, pack, packed, partitions, real_id, slices, text_buffer, unpack, unpacked, word_hashes, words_of, written,
)
from jobweave.llm.components import connected_components

POINT = 64
LIGHT = 2
#: Shingles that one tile of a large component holds at most.
TILE = 2_000_000
NODE = 32
#: Bytes of text whose shingles are dealt together, about.
PART = 16 << 20


@dataclass(frozen=True)
class Rule:
    """Words of a shingle, and the similarity ``num / den`` from which two sets are linked."""

    words: int = 3
    num: int = 90
    den: int = 100


RULE = Rule()


def size_classes(rule: Rule = RULE) -> np.ndarray:
    """Lower bounds of the size classes: below the first only equal sets are similar enough."""
    bounds = [rule.num // (rule.den - rule.num)]
    while bounds[-1] < 1 << 40:
        bounds.append(max(bounds[-1] + 1, int(bounds[-1] * 1.3)))
    return np.array(bounds, np.int64)


def slab_counts(classes: np.ndarray, rule: Rule = RULE) -> np.ndarray:
    """Slabs of each class: one more than the largest distance of a pair whose smaller set is in the class."""
    return (classes[1:] - 1) * (rule.den - rule.num) // rule.num + 1


def document_sets(part: pa.RecordBatch, words_each: int = RULE.words) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of all rows in one array, and the number of each row."""
    data, bounds = text_buffer(filled(part.column("text")))
    data = LOWER[data]
    starts, ends, words = words_of(data, bounds)
    hashed = word_hashes(data, starts, ends)
    odd = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
    odd += (mix(np.arange(3, words_each, dtype=np.uint64) + odd[0]) | np.uint64(1)).tolist()
    odd = [np.uint64(x) for x in odd]
    whole = np.zeros(len(hashed), np.uint64)
    for n in range(min(words_each, len(hashed))):
        whole[: len(hashed) - n] += hashed[n:] * odd[n]
    whole = mix(whole)
    sets = []
    for a, b in zip(words[:-1].tolist(), words[1:].tolist(), strict=True):
        if b - a >= words_each:
            sets.append(np.unique(whole[a : b - words_each + 1]))
        elif b > a:
            sets.append(mix((hashed[a:b] * np.array(odd[: b - a])).sum(keepdims=True) + np.full(1, b - a, np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), sizes


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Wrapping sums of consecutive runs."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        out[full] = np.add.reduceat(values, (np.cumsum(sizes) - sizes)[full])
    return out


def digests(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return sums(mix(tokens ^ np.uint64(0x1234567)), sizes), sums(mix(tokens * np.uint64(0xD6E8FEB86659FD93)), sizes)


def pieces_of(sizes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Positions of the tokens of the chosen rows, one row after the other."""
    starts = np.cumsum(sizes) - sizes
    own = sizes[rows]
    before = np.cumsum(own) - own
    return np.arange(int(own.sum())) - np.repeat(before, own) + np.repeat(starts[rows], own)


def slab_records(tokens: np.ndarray, sizes: np.ndarray, rows: np.ndarray, classes: np.ndarray, slabs: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, ...]:
    """``row, signature, shingles`` of every slab of the chosen rows, each row under its given class."""
    count = slabs[kind]
    first = np.cumsum(count) - count
    at = pieces_of(sizes, rows)
    own = np.repeat(np.arange(len(rows)), sizes[rows])
    token = tokens[at]
    slab = ((token >> np.uint64(32)) * count[own].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    cell = first[own] + slab
    total = int(count.sum())
    shingles = np.bincount(cell, minlength=total)
    group = mix((token & np.uint64(0xFFFF)) + np.uint64(0x51ED27))
    signature = sums(group, shingles)
    row = np.repeat(np.arange(len(rows)), count)
    number = np.arange(total) - np.repeat(first, count)
    salt = mix((classes[kind][row].astype(np.uint64) << np.uint64(24)) + number.astype(np.uint64))
    return rows[row], mix(signature + salt), shingles


def forest(n: int) -> tuple[Callable[[int], int], Callable[[int, int], bool]]:
    """Find and union over ``n`` items."""
    up = list(range(n))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def unite(x: int, y: int) -> bool:
        x, y = find(x), find(y)
        if x == y:
            return False
        up[max(x, y)] = min(x, y)
        return True

    return find, unite


def enough(overlap: np.ndarray, both: np.ndarray, rule: Rule = RULE) -> np.ndarray:
    """Whether an overlap allows the similarity, for the sum of both sizes: den * o >= num * (both - o)."""
    return (rule.den + rule.num) * overlap.astype(np.int64) >= rule.num * both


def rtree_links(
    points: np.ndarray, sizes: np.ndarray, verify: Callable[[int, int], bool] | None, cut: int | None = None, rule: Rule = RULE,
    joined: tuple[Callable[[int], int], Callable[[int, int], bool], np.ndarray] | None = None,
) -> list[tuple[int, int]]:
    """Links that join parts of the set: a packed R-tree of count vectors joined with itself.

    Leaves hold ``NODE`` points sorted by size and counts; a node keeps the largest count of each group and its least size.
    Pairs of nodes are dropped where the summed minima of their largest counts cannot reach the overlap that their least sizes ask
    for. ``cut``: only pairs between the first ``cut`` points and the rest are wanted. Pairs that are already connected are
    passed over, so as many links come back as there are merges.
    """
    n = len(points)
    order = np.lexsort((points[:, 1 % points.shape[1]], points[:, 0], sizes))
    points, sizes = points[order].astype(np.int32), sizes[order]
    side = order < cut if cut is not None else None
    levels = [(points, sizes, sizes)]
    while len(levels[-1][0]) > 1:
        top, low, high = levels[-1]
        heads = np.arange(0, len(top), NODE)
        levels.append((np.maximum.reduceat(top, heads), np.minimum.reduceat(low, heads), np.maximum.reduceat(high, heads)))
    find, unite = forest(n)
    if joined is not None:
        find_all, unite_all, number = joined[0], joined[1], joined[2][order].tolist()
        find, unite = lambda x: find_all(number[x]), lambda x, y: unite_all(number[x], number[y])
    links = []
    stack = [(len(levels) - 1, 0, 0)]
    while stack:
        level, i, j = stack.pop()
        if level == 0:
            continue
        top, low, high = levels[level - 1]
        a0, a1 = i * NODE, min((i + 1) * NODE, len(top))
        b0, b1 = j * NODE, min((j + 1) * NODE, len(top))
        if level == 1:
            roots_a, roots_b = {find(x) for x in range(a0, a1)}, {find(x) for x in range(b0, b1)}
            if len(roots_a | roots_b) == 1:
                continue
        overlap = np.empty((a1 - a0, b1 - b0), np.int64)
        for x in range(a0, a1):
            np.minimum(top[x], top[b0:b1]).sum(axis=1, out=overlap[x - a0])
        fits = enough(overlap, low[a0:a1, None] + low[None, b0:b1], rule)
        fits &= (rule.den * high[None, b0:b1] >= rule.num * low[a0:a1, None]) & (rule.den * high[a0:a1, None] >= rule.num * low[None, b0:b1])
        for x, y in zip(*(v.tolist() for v in np.nonzero(fits)), strict=True):
            x, y = x + a0, y + b0
            if x > y or (x == y and level == 1):
                continue
            if level > 1:
                stack.append((level - 1, x, y))
            elif (side is None or side[x] != side[y]) and find(x) != find(y) and (verify is None or verify(int(order[x]), int(order[y]))):
                unite(x, y)
                links.append((int(order[x]), int(order[y])))
    return links


def shared_shingles(source: DataFrame, buckets: int, rule: Rule = RULE) -> DataFrame:
    """``doc_id, n_shared``: how many shingles of a document occur in other rows as well, or a few more, as 40 bits stand for a shingle of a range.

    The rows of a part (``PART`` bytes of text, about) are known by their number in it, and its ids move once, however many ranges its shingles
    are dealt to: what a shingle takes does not grow with the number of ranges.
    """
    names = ["bucket", "part", "shingles", "rows", "docs"]
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def rows_of(found: list[tuple]) -> list[pa.Array]:
        return [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]

    def send(number: int, sets: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        tokens, sizes, doc = (np.concatenate(c) for c in zip(*sets, strict=True))
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = ((tokens >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        short = tokens & np.uint64((1 << 40) - 1)
        order = np.lexsort((short, place))
        place, short, row = place[order], short[order], row[order]
        cuts = np.searchsorted(place, np.arange(buckets + 1)).tolist()
        found = [(number % buckets, number, None, None, packed(doc.view(np.uint64)))]
        found += [(b, number, packed(np.diff(short[x:y], prepend=np.uint64(0))), packed(row[x:y]), None) for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if x < y]
        return pa.RecordBatch.from_arrays(rows_of(found), names)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, sets, held = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, sizes = document_sets(part, rule.words)
                sets.append((tokens, sizes, ids(part.column("doc_id"))))
                held += SLICE_BYTES
                if held >= PART:
                    yield send(number, sets)
                    number, sets, held = number + 1, [], 0
        if sets:
            yield send(number, sets)

    def count(table: pa.Table) -> pa.Table:
        rows = list(zip(*(table.column(c).to_pylist() for c in names[1:]), strict=True))
        given = [(part % buckets, part, None, None, docs) for part, _, _, docs in rows if docs is not None]
        sent = [(part, np.cumsum(unpacked(s)), unpacked(r).astype(np.int64)) for part, s, r, _ in rows if s is not None]
        if sent:
            _, group, n = np.unique(np.concatenate([s for _, s, _ in sent]), return_inverse=True, return_counts=True)
            twice = np.split(n[group.ravel()] > 1, np.cumsum([len(s) for _, s, _ in sent])[:-1])
            for (part, _, row), often in zip(sent, twice, strict=True):
                own, times = np.unique(row[often], return_counts=True)
                if len(own):
                    given.append((part % buckets, part, packed(times), packed(np.diff(own, prepend=0)), None))
        return pa.Table.from_arrays(rows_of(given), names=names)

    def add(table: pa.Table) -> pa.Table:
        docs: dict[int, np.ndarray] = {}
        sums: dict[int, list] = {}
        for part, times, rows, doc in zip(*(table.column(c).to_pylist() for c in names[1:]), strict=True):
            if doc is not None:
                docs[part] = unpacked(doc).view(np.int64)
            else:
                sums.setdefault(part, []).append((np.cumsum(unpacked(rows).astype(np.int64)), unpacked(times)))
        found = []
        for part, each in sums.items():
            total = np.zeros(len(docs[part]), np.int64)
            for row, times in each:
                total[row] += times.astype(np.int64)
            found.append((docs[part][total > 0], total[total > 0]))
        doc, n = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in (0, 1))
        return pa.table({"doc_id": pa.array(doc), "n_shared": pa.array(n)})

    kind = "bucket int, part long, shingles binary, rows binary, docs binary"
    counted = source.mapInArrow(deal, kind).groupBy("bucket").applyInArrow(count, kind)
    return counted.groupBy("bucket").applyInArrow(add, "doc_id long, n_shared long").groupBy("doc_id").agg(F.sum("n_shared").alias("n_shared"))


def candidate_edges(source: DataFrame, buckets: int, rule: Rule = RULE, staying: np.ndarray | None = None) -> DataFrame:
    """Edges ``a, b`` that connect all documents which agree in a slab, of those whose bit in ``staying`` is set."""
    shared = None if staying is None else source.sparkSession.sparkContext.broadcast(staying)
    names = ["mark", "doc", "light_mark", "light_doc", "light_size", "light_point", "known_a", "known_b"]
    kinds = ["u8", "i8", "u8", "i8", "i8", "u1", "i8", "i8"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = size_classes(rule)
        slabs = slab_counts(classes, rule)
        for batch in batches:
            if shared is not None:
                batch = batch.filter(pa.array(is_set(shared.value, mix(ids(batch.column("doc_id"))))))
            for part in slices(batch, "text"):
                yield from deal_slice(part, classes, slabs)

    def deal_slice(part: pa.RecordBatch, classes: np.ndarray, slabs: np.ndarray) -> Iterator[pa.RecordBatch]:
        doc = ids(part.column("doc_id"))
        tokens, sizes = document_sets(part, rule.words)
        low, high = digests(tokens, sizes)
        first = np.unique(np.stack([low, high, sizes.astype(np.uint64)]), axis=1, return_index=True)[1]
        rows = np.sort(first[sizes[first] >= classes[0]])
        if not len(rows):
            return
        own = np.searchsorted(classes, sizes[rows], "right") - 1
        smaller = -(-sizes[rows] * rule.num // rule.den)
        other = np.searchsorted(classes, smaller, "right") - 1
        more = (other < own) & (other >= 0)
        row, mark, shingles = slab_records(tokens, sizes, np.r_[rows, rows[more]], classes, slabs, np.r_[own, other[more]])
        light = shingles <= LIGHT
        heavy_row, heavy = row[~light], mark[~light]
        order = np.argsort(heavy, kind="stable")
        heavy_row, heavy = heavy_row[order], heavy[order]
        fresh = np.r_[True, heavy[1:] != heavy[:-1]] if len(heavy) else np.zeros(0, bool)
        center = heavy_row[np.maximum.accumulate(np.where(fresh, np.arange(len(heavy)), 0))] if len(heavy) else heavy_row
        linked = np.unique(np.stack([heavy_row[~fresh], center[~fresh]]), axis=1)
        sent: dict[int, list[bytes]] = {}

        def put(at: int, packed: Iterator[tuple[int, list[bytes]]]) -> None:
            for b, v in packed:
                sent.setdefault(b, [b""] * 8)[at : at + len(v)] = v

        put(0, pack((heavy[fresh] % np.uint64(buckets)).astype(np.int32), heavy[fresh], doc[heavy_row[fresh]]))
        light_rows, inverse = np.unique(row[light], return_inverse=True)
        if len(light_rows):
            at = pieces_of(sizes, light_rows)
            line = np.repeat(np.arange(len(light_rows)), sizes[light_rows])
            group = ((tokens[at] >> np.uint64(16)) & np.uint64(POINT - 1)).astype(np.int64)
            points = np.bincount(line * POINT + group, minlength=len(light_rows) * POINT).reshape(-1, POINT)
            points = np.minimum(points, 255).astype(np.uint8)[inverse]
            put(2, pack((mark[light] % np.uint64(buckets)).astype(np.int32), mark[light], doc[row[light]], sizes[row[light]], points))
        put(6, pack((mix(linked[0].astype(np.uint64)) % np.uint64(buckets)).astype(np.int32), doc[linked[0]], doc[linked[1]]))
        if sent:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sent), pa.int32())] + [pa.array([v[i] for v in sent.values()], pa.binary()) for i in range(8)], ["bucket", *names]
            )

    def match(table: pa.Table) -> pa.Table:
        mark, doc, light_mark, light_doc, light_size, light_point, known_a, known_b = unpack(table, names, kinds)
        order = np.argsort(mark, kind="stable")
        mark, doc = mark[order], doc[order]
        fresh = np.r_[True, mark[1:] != mark[:-1]] if len(mark) else np.zeros(0, bool)
        center = doc[np.maximum.accumulate(np.where(fresh, np.arange(len(mark)), 0))] if len(mark) else doc
        a, b = [known_a, doc[~fresh]], [known_b, center[~fresh]]
        # one forest over the documents of the bucket: what one mark has joined, the next need not find again
        known = np.unique(np.concatenate([light_doc, *a, *b]))
        find, unite = forest(len(known))
        for x, y in zip(np.searchsorted(known, np.concatenate(a)).tolist(), np.searchsorted(known, np.concatenate(b)).tolist(), strict=True):
            unite(x, y)
        number = np.searchsorted(known, light_doc)
        light_point = light_point.reshape(-1, POINT)
        order = np.argsort(light_mark, kind="stable")
        light_mark = light_mark[order]
        cuts = np.flatnonzero(np.r_[True, light_mark[1:] != light_mark[:-1]]) if len(light_mark) else np.zeros(0, np.int64)
        for x, y in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)], strict=True) if len(cuts) else ():
            if y - x > 1:
                rows = order[x:y]
                if len({find(d) for d in number[rows].tolist()}) == 1:
                    continue
                points = light_point[rows].astype(np.int32)
                points[points == 255] = 1 << 24
                found = rtree_links(points, light_size[rows], None, rule=rule, joined=(find, unite, number[rows]))
                a.append(light_doc[rows[[i for i, _ in found]]] if found else known_a[:0])
                b.append(light_doc[rows[[j for _, j in found]]] if found else known_b[:0])
        a, b = distinct_pairs(np.concatenate(a), np.concatenate(b))
        packed = list(pack((mix(a.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32), a, b))
        return pa.table({"bucket": pa.array([n for n, _ in packed], pa.int32()), "a": pa.array([v[0] for _, v in packed], pa.binary()), "b": pa.array([v[1] for _, v in packed], pa.binary())})

    def merge(table: pa.Table) -> pa.Table:
        a, b = distinct_pairs(*unpack(table, ["a", "b"], ["i8", "i8"]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    dealt = source.mapInArrow(deal, "bucket int, " + ", ".join(f"{n} binary" for n in names))
    matched = dealt.groupBy("bucket").applyInArrow(match, "bucket int, a binary, b binary")
    return matched.groupBy("bucket").applyInArrow(merge, "a long, b long")


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once, the larger id first, without pairs of one id."""
    pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
    pairs = pairs[:, pairs[0] != pairs[1]]
    return pairs[0], pairs[1]


def verified_edges(source: DataFrame, candidates: DataFrame, buckets: int, rule: Rule = RULE, staying: np.ndarray | None = None) -> DataFrame:
    """Links ``a, b`` between the candidates (``doc_id, part, tile, tiles``) that join all linked documents; their bits in ``staying`` are set."""
    shared = None if staying is None else source.sparkSession.sparkContext.broadcast(staying)

    def stay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(is_set(shared.value, mix(ids(batch.column("doc_id"))))))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, sizes = document_sets(part, rule.words)
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("part"), part.column("tile"), part.column("tiles"),
                     pa.array([tokens[e - n : e].tobytes() for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)], pa.binary())],
                    ["doc_id", "part", "tile", "tiles", "tokens"],
                )

    def link(table: pa.Table) -> pa.Table:
        doc = table.column("doc_id").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()]
        keys = list(zip(table.column("part").to_pylist(), table.column("left").to_pylist(), table.column("right").to_pylist(), strict=True))
        tile = table.column("tile").to_numpy()
        members: dict[tuple, list[int]] = {}
        for i in np.lexsort((doc,)).tolist():
            members.setdefault(keys[i], []).append(i)
        a, b = [], []
        for (_, left, right), rows in members.items():
            if left != right:
                rows = [i for i in rows if tile[i] == left] + [i for i in rows if tile[i] != left]
            own = [sets[i] for i in rows]
            sizes = np.fromiter(map(len, own), np.int64, len(own))
            groups = 1 << min(10, max(4, int(np.median(sizes)).bit_length()))
            points = np.stack([np.bincount((s >> np.uint64(8) & np.uint64(groups - 1)).astype(np.int64), minlength=groups) for s in own])

            def same(i: int, j: int, own: list = own) -> bool:
                shared = len(np.intersect1d(own[i], own[j], assume_unique=True))
                return rule.den * shared >= rule.num * (len(own[i]) + len(own[j]) - shared)

            for i, j in rtree_links(points, sizes, same, None if left == right else sum(1 for r in rows if tile[r] == left), rule):
                a.append(int(doc[rows[i]]))
                b.append(int(doc[rows[j]]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    if shared is not None:
        # texts that are no candidates do not move
        source = source.mapInArrow(stay, source.schema)
    # the hint keeps the plan the same at every size
    sets = source.join(candidates.hint("merge"), "doc_id").mapInArrow(gather, "doc_id long, part long, tile int, tiles int, tokens binary")
    paired = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "doc_id", "part", "tile", F.least("tile", "other").alias("left"), F.greatest("tile", "other").alias("right"), "tokens"
    )
    bucket = F.pmod(F.xxhash64("part", "left", "right"), F.lit(buckets)).cast("int")
    return paired.groupBy(bucket.alias("bucket")).applyInArrow(link, "a long, b long")


def mixed_ids(docs: DataFrame) -> DataFrame:
    """``h``: the mixed ids, as the tasks mix them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(mix(ids(batch.column("doc_id"))).view(np.int64))], ["h"])

    return docs.select("doc_id").mapInArrow(run, "h long")


def jaccard_components(docs: DataFrame, text: str = "text", id_col: str = "doc_id", rule: Rule = RULE) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every document: components of pairs that the rule links.

    Null and empty texts and texts without words have no shingles and are linked with nothing. A null id counts as the lowest id
    and comes back as null. Rows that repeat an id are one document; if their texts differ, each of them has its size
    and the id belongs to the components of all. Other columns are not read.
    """
    source = keyed(docs.withColumn("text", F.col(text).cast("string")), id_col, "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, sizes = document_sets(part, rule.words)
                low, high = digests(tokens, sizes)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes), pa.array(low.view(np.int64)), pa.array(high.view(np.int64)), pa.array(np.diff(text_buffer(filled(part.column("text")))[1]))],
                    ["doc_id", "n_shingles", "low", "high", "bytes"],
                )

    sets = written(source.mapInArrow(measure, "doc_id long, n_shingles long, low long, high long, bytes long"), "sets")
    key = ["n_shingles", "low", "high"]
    heads = sets.where("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("head"))
    members = written(sets.drop("bytes").join(heads, key, "left").select("doc_id", "n_shingles", F.coalesce("head", "doc_id").alias("head")), "members")
    size = sets.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    buckets = max(partitions(docs.sparkSession), size // (12 << 20) + 1)
    names = members.where("n_shingles > 0").select("doc_id", "head")
    least = sets.where("n_shingles > 0").groupBy("doc_id").agg(F.min("n_shingles").alias("n"))
    # of equal sets only the head is dealt
    heads_only = members.where("doc_id = head").select("doc_id").distinct()
    enough_shared = shared_shingles(source, buckets, rule).join(least, "doc_id").where(rule.den * F.col("n_shared") >= rule.num * F.col("n")).join(heads_only, "doc_id")
    found = candidate_edges(source, buckets, rule, bitmap(mixed_ids(enough_shared)))
    edges = (
        found.join(names.select(F.col("doc_id").alias("a"), F.col("head").alias("head_a")), "a")
        .join(names.select(F.col("doc_id").alias("b"), F.col("head").alias("head_b")), "b")
        .select(F.col("head_a").alias("a"), F.col("head_b").alias("b"))
    )
    parts = connected_components(edges)
    weighed = written(
        parts.join(members.where("doc_id = head").groupBy("doc_id").agg(F.max("n_shingles").alias("n")), F.col("node") == F.col("doc_id")).select("doc_id", "label", "n"),
        "parts",
    )
    heavy = weighed.groupBy("label").agg(F.ceil(F.sum("n") / TILE).cast("int").alias("tiles"))
    candidates = weighed.join(heavy, "label").select(
        "doc_id", F.col("label").alias("part"), F.pmod(F.xxhash64("doc_id"), F.col("tiles")).cast("int").alias("tile"), "tiles"
    )
    labels = connected_components(verified_edges(source, candidates, buckets, rule, bitmap(mixed_ids(weighed))))
    return members.join(labels, F.col("head") == F.col("node"), "left").select(
        real_id().alias("doc_id"), "n_shingles", F.when(F.coalesce("label", "head") != NULL_ID, F.coalesce("label", "head")).alias("component_id")
    )

