"""Repeated byte strings across documents, by a distributed sparse suffix array.

A string of ``LENGTH`` bytes that starts earlier elsewhere is found without a suffix for every byte. In each
window of ``LENGTH`` bytes one gram of ``GRAM`` bytes is the least by a hash; equal windows choose the same place in them, so it is
enough to sort the suffixes that start at chosen grams, each with the stretch of windows that chose it.

1. Chosen grams are counted by fingerprint. Each batch counts its own first, so a gram of any frequency is at most one row per
   batch; grams that stand once in the corpus are done with.
2. The suffixes at repeated grams are dealt into ranges by their leading bytes, between splitters taken from a sample of documents. Equal
   grams are never parted by a splitter, so nothing has to be compared across the ends of a range. Grams that are frequent in the
   sample are cut into short stretches of windows, and those are dealt by the longer leading strings that all their windows share.
3. A range sorts its suffixes by a multikey quicksort, word by word and only within ties, and likewise what stands before
   them, read backwards. Neighbours' common prefixes give the class of every window; all but the first of a class are marked.
   Batches do the same before the exchange, so of a string repeated in a batch only the first copy travels.
4. The marked windows of a document are merged and cut out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobweave.llm.common import (
    byte_codes, filled, id_array, ids, keyed, mix, pack, partitions, row_keys, slices, text_buffer, unpack, written,
)

LENGTH = 100
GRAM = 40
SPAN = LENGTH - GRAM + 1
#: Documents of the sample that splitters and frequent grams come from, at about which it is held at any size of the corpus.
SAMPLE_DOCS = 2000
#: Grams of that sample that reach the driver at most, about.
SAMPLE_GRAMS = 100_000
#: Windows in a stretch of a frequent gram.
STRETCH = 8
SLICE = 1 << 20


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place on, by doubling."""
    level, size, at_8 = byte_codes()[data], 1, None
    for n, odd in enumerate((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)):
        level = level[:-size] * np.uint64(odd) + level[size:]
        level ^= level >> np.uint64(31 - n)
        size *= 2
        if size == 8:
            at_8 = level
    return mix(level[: len(data) - GRAM + 1] * np.uint64(0x94D049BB133111EB) + at_8[32 : 32 + len(data) - GRAM + 1])


def chosen_grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``place, fingerprint, first window, last window`` of each chosen gram; windows lie within rows."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none.astype(np.uint64), none, none
    hashes = gram_hashes(data)
    # the same bits of a hash in slices of every size (texts beyond 64 MB apart), so that equal windows choose alike; ties go to the first gram
    shift = np.uint64(max(26, int(len(hashes)).bit_length()))
    least = (hashes >> shift << shift) | np.arange(len(hashes), dtype=np.uint64)
    size = 1
    while size * 2 <= SPAN:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = SPAN - size
    least = np.minimum(least[: len(least) - rest], least[rest:])
    owner = (least & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    open_ = np.zeros(len(data) + 1, np.int32)
    long_rows = np.diff(bounds) >= LENGTH
    np.add.at(open_, bounds[:-1][long_rows], 1)
    np.add.at(open_, bounds[1:][long_rows] - LENGTH + 1, -1)
    windows = np.flatnonzero(np.cumsum(open_)[: len(owner)])
    if not len(windows):
        return none, none.astype(np.uint64), none, none
    owner = owner[windows]
    heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    tails = np.r_[heads[1:], len(owner)] - 1
    return owner[heads], hashes[owner[heads]], windows[heads], windows[tails]


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """The order of byte rows: sorted by their first eight bytes, then ties alone by the next eight, and so on."""
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order = np.argsort(words[:, 0], kind="stable")
    group = np.cumsum(np.r_[0, words[order[1:], 0] != words[order[:-1], 0]])
    for k in range(1, words.shape[1]):
        tied = np.r_[False, group[1:] == group[:-1]]
        tied[:-1] |= tied[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        inner = np.lexsort((words[order[at], k], group[at]))
        order[at] = order[at][inner]
        fresh = np.r_[False, (group[1:] != group[:-1]) | (words[order[1:], k] != words[order[:-1], k])]
        group = np.cumsum(fresh)
    return order


def classes_by_depth(rows: np.ndarray, depths: range) -> Iterator[np.ndarray]:
    """For each depth, equal numbers for rows that begin alike to that depth."""
    order = multikey_order(rows)
    differ = rows[order[1:]] != rows[order[:-1]]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    for depth in depths:
        out = np.empty(len(order), np.int64)
        out[order] = np.r_[0, np.cumsum(common < depth)] if len(order) else 0
        yield out


def mark_repeats(data: np.ndarray, place: np.ndarray, least: np.ndarray, most: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which windows equal an earlier one: a row per suffix, a column per distance from window start to suffix.

    ``place`` is the suffix's index in ``data``, ``doc`` and ``at`` its document and its offset there; it stands for the windows
    that start ``least`` to ``most`` bytes before it. Rows must be ordered by ``doc, at``.
    """
    marks = np.zeros((len(place), SPAN), bool)
    if len(place) < 2:
        return marks
    step = np.arange(104)
    after = np.where(step < (LENGTH - least)[:, None], data[np.minimum(place[:, None] + step, len(data) - 1)], 0).astype(np.uint8)
    back = np.arange(64)
    before = np.where(back < most[:, None], data[np.maximum(place[:, None] - 1 - back, 0)], 0).astype(np.uint8)
    for distance, (right, left) in enumerate(
        zip(classes_by_depth(after, range(LENGTH, LENGTH - SPAN, -1)), classes_by_depth(before, range(SPAN)), strict=True)
    ):
        rows = np.flatnonzero((least <= distance) & (distance <= most))
        if len(rows) < 2:
            continue
        key = left[rows] * (len(place) + 1) + right[rows]
        order = np.argsort(key, kind="stable")
        fresh = np.r_[True, key[order[1:]] != key[order[:-1]]]
        first = rows[order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]]
        own = rows[order]
        marks[own, distance] = (doc[own] != doc[first]) | (at[own] != at[first])
    return marks


def stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, first, last`` of the runs of true cells."""
    wide = np.zeros((flags.shape[0], flags.shape[1] + 2), np.int8)
    wide[:, 1:-1] = flags
    change = np.diff(wide, axis=1)
    rows, first = np.nonzero(change == 1)
    return rows, first, np.nonzero(change == -1)[1] - 1


def slice_grams(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    data, bounds = text_buffer(filled(part.column("text")))
    place, mark, first, last = chosen_grams(data, bounds)
    row = np.searchsorted(bounds, place, "right") - 1
    return data, bounds, row, place, mark, first, last


#: Values of many documents in one row: the bucket of the documents, their ids, and int32 values for each id.
PACKED = "bucket int, doc binary, value binary"


def by_document(doc: np.ndarray, value: np.ndarray, buckets: int) -> pa.Table:
    """Values of documents, packed by a hash of the document's id."""
    packed = list(pack((mix(doc.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32), doc, value))
    return pa.table({"bucket": pa.array([b for b, _ in packed], pa.int32()), "doc": pa.array([v[0] for _, v in packed], pa.binary()), "value": pa.array([v[1] for _, v in packed], pa.binary())})


def gathered(packed: DataFrame, name: str) -> DataFrame:
    """One row for each document: ``doc_id`` and its values, in the column ``name``."""

    def run(table: pa.Table) -> pa.Table:
        doc, value = unpack(table, ["doc", "value"], ["i8", "i4"])
        value = value.reshape(len(doc), -1) if len(doc) else value
        order = np.argsort(doc, kind="stable")
        doc, value = doc[order], value[order]
        heads = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, np.int64)
        blobs = [value[a:b].tobytes() for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(doc)], strict=True)] if len(doc) else []
        return pa.table({"doc_id": pa.array(doc[heads], pa.int64()), name: pa.array(blobs, pa.binary())})

    return packed.groupBy("bucket").applyInArrow(run, f"doc_id long, {name} binary")


def repeated_grams(source: DataFrame, buckets: int) -> DataFrame:
    """``doc_id, places``: for each document the offsets (packed int32) of its chosen grams that stand more than once."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, docs, places = [], [], []
            for part in slices(batch, "text", SLICE):
                _, bounds, row, place, mark, _, _ = slice_grams(part)
                marks.append(mark)
                docs.append(ids(part.column("doc_id"))[row])
                places.append((place - bounds[row]).astype(np.int32))
            if not marks:
                continue
            mark, doc, place = np.concatenate(marks), np.concatenate(docs), np.concatenate(places)
            order = np.argsort(mark, kind="stable")
            mark, doc, place = mark[order], doc[order], place[order]
            fresh = np.r_[True, mark[1:] != mark[:-1]] if len(mark) else np.zeros(0, bool)
            heads = np.flatnonzero(fresh)
            many = (np.diff(np.r_[heads, len(mark)]) > 1).astype(np.uint8)
            sent = {b: v + [b"", b""] for b, v in pack((mark[heads] % np.uint64(buckets)).astype(np.int32), mark[heads], doc[heads], place[heads], many)}
            known = ~fresh
            spread = (mix(doc[known].astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)
            for b, v in pack(spread, doc[known], place[known]):
                sent.setdefault(b, [b""] * 6)[4:] = v
            if sent:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(sent), pa.int32())] + [pa.array([v[i] for v in sent.values()], pa.binary()) for i in range(6)],
                    ["bucket", "mark", "doc", "place", "many", "known_doc", "known_place"],
                )

    def count(table: pa.Table) -> pa.Table:
        mark, doc, place, many, known_doc, known_place = unpack(
            table, ["mark", "doc", "place", "many", "known_doc", "known_place"], ["u8", "i8", "i4", "u1", "i8", "i4"]
        )
        order = np.argsort(mark, kind="stable")
        same = mark[order[1:]] == mark[order[:-1]]
        repeated = many[order] > 0
        if len(order):
            repeated |= np.r_[False, same] | np.r_[same, False]
        keep = order[repeated]
        return by_document(np.r_[doc[keep], known_doc], np.r_[place[keep], known_place], buckets)

    dealt = source.mapInArrow(deal, "bucket int, mark binary, doc binary, place binary, many binary, known_doc binary, known_place binary")
    return gathered(dealt.groupBy("bucket").applyInArrow(count, PACKED), "places")


def sampled_grams(source: DataFrame, docs: int, size: int) -> tuple[list[bytes], list[bytes]]:
    """Chosen grams of about ``SAMPLE_DOCS`` documents: a hashed eighth or less of them for the splitters, and all that are frequent.

    Every gram of the sample is counted. A gram is frequent in more than a hundredth of the sampled documents, so there are at most a hundred
    times as many as a document has.
    """
    every = max(1, docs // SAMPLE_DOCS)
    share = max(8, int(2 * size / (SPAN + 1) / every / SAMPLE_GRAMS))
    often = max(4, min(docs, SAMPLE_DOCS) // 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                data, _, row, place, mark, _, _ = slice_grams(part)
                each = np.unique(np.stack([row.astype(np.uint64), mark]), axis=1, return_index=True)[1] if len(row) else np.zeros(0, np.int64)
                raw = data.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([raw[p : p + GRAM] for p in place[each].tolist()], pa.binary()), pa.array(mark[each] % np.uint64(share) == 0)], ["gram", "thin"]
                )

    sample = source.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).mapInArrow(run, "gram binary, thin boolean")
    rows = sample.groupBy("gram", "thin").agg(F.count(F.lit(1)).alias("n")).where(F.col("thin") | (F.col("n") > often)).collect()
    return [bytes(r["gram"]) for r in rows if r["thin"]], [bytes(r["gram"]) for r in rows if r["n"] > often]


def marked_spans(source: DataFrame, places: DataFrame, splitters: np.ndarray, frequent: np.ndarray, buckets: int) -> DataFrame:
    """``doc_id, spans``: runs of removed bytes as packed int32 pairs of start and end; runs of a document may overlap."""
    import zstandard

    shared = source.sparkSession.sparkContext.broadcast((splitters, frequent))

    def bucket_of(data: np.ndarray, raw: bytes, place: np.ndarray, least: np.ndarray, hot: np.ndarray, splits: np.ndarray) -> np.ndarray:
        grams = np.ascontiguousarray(data[place[:, None] + np.arange(GRAM)]).view(f"S{GRAM}").ravel()
        out = np.searchsorted(splits, grams, "right").astype(np.int32)
        for i in np.flatnonzero(hot).tolist():
            near = int(least[i]) // STRETCH * STRETCH
            out[i] = zlib.crc32(raw[place[i] - near : place[i] - near + LENGTH - STRETCH + 1]) % buckets
        return out

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits, hot_grams = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                yield from deal_slice(part, splits, hot_grams)

    def deal_slice(part: pa.RecordBatch, splits: np.ndarray, hot_grams: np.ndarray) -> Iterator[pa.RecordBatch]:
        doc_ids = ids(part.column("doc_id"))
        order = np.argsort(doc_ids, kind="stable")
        part = part.take(pa.array(order))
        doc_ids = doc_ids[order]
        data, bounds, row, place, _, first, last = slice_grams(part)
        wanted = np.zeros(len(data) + 1, bool)
        for base, end, blob in zip(bounds[:-1].tolist(), bounds[1:].tolist(), part.column("places").to_pylist(), strict=True):
            at = np.frombuffer(blob, np.int32) + base
            wanted[at[at < end]] = True
        keep = wanted[place]
        row, place, first, last = row[keep], place[keep], first[keep], last[keep]
        if not len(place):
            return
        doc, at, least, most = doc_ids[row], place - bounds[row], place - last, place - first
        grams = np.ascontiguousarray(data[place[:, None] + np.arange(GRAM)]).view(f"V{GRAM}").ravel()
        _, inverse, sizes = np.unique(grams.view(f"S{GRAM}"), return_inverse=True, return_counts=True)
        marks = np.zeros((len(place), SPAN), bool)
        near = np.flatnonzero(sizes[inverse] > 1)
        marks[near] = mark_repeats(data, place[near], least[near], most[near], doc[near], at[near])
        step = np.arange(SPAN)
        open_ = (least[:, None] <= step) & (step <= most[:, None])
        rows, lo, hi = stretches(marks)
        known = (doc[rows], (at[rows] - hi).astype(np.int32), (at[rows] - lo + LENGTH).astype(np.int32))
        open_ &= ~marks
        hot = np.isin(grams.view(f"S{GRAM}"), hot_grams)
        rows, lo, hi = stretches(open_ & ~hot[:, None])
        hot_of = np.zeros(len(rows), bool)
        if hot.any():
            for begin in range(0, SPAN, STRETCH):
                only = np.zeros(SPAN, bool)
                only[begin : begin + STRETCH] = True
                more = stretches(open_ & hot[:, None] & only)
                rows, lo, hi = np.r_[rows, more[0]], np.r_[lo, more[1]], np.r_[hi, more[2]]
                hot_of = np.r_[hot_of, np.ones(len(more[0]), bool)]
        raw = data.tobytes()
        bucket = bucket_of(data, raw, place[rows], lo, hot_of, splits)
        order = np.argsort(bucket, kind="stable")
        rows, lo, hi, bucket = rows[order], lo[order], hi[order], bucket[order]
        starts, ends = place[rows] - hi, place[rows] - lo + LENGTH
        columns = (doc[rows], at[rows].astype(np.int32), lo.astype(np.int16), hi.astype(np.int16))
        sent: dict[int, list[bytes]] = {}
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, np.int64)
        squeeze = zstandard.ZstdCompressor(level=1)
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)], strict=True) if len(bucket) else ():
            body = b"".join([raw[s:e] for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)])
            sent[int(bucket[a])] = [c[a:b].tobytes() for c in columns] + [squeeze.compress(body), b"", b"", b""]
        for b, v in pack((mix(known[0].astype(np.uint64)) % np.uint64(buckets)).astype(np.int32), *known):
            sent.setdefault(b, [b""] * 8)[5:] = v
        if sent:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sent), pa.int32())] + [pa.array([v[i] for v in sent.values()], pa.binary()) for i in range(8)],
                ["bucket", "doc", "at", "least", "most", "body", "known_doc", "known_start", "known_end"],
            )

    def sort(table: pa.Table) -> pa.Table:
        doc, at, least, most, known_doc, known_start, known_end = unpack(
            table, ["doc", "at", "least", "most", "known_doc", "known_start", "known_end"], ["i8", "i4", "i2", "i2", "i8", "i4", "i4"]
        )
        body = np.frombuffer(b"".join([zstandard.decompress(x) for x in table.column("body").to_pylist() if x]), np.uint8)
        least, most = least.astype(np.int64), most.astype(np.int64)
        sizes = most - least + LENGTH
        place = np.cumsum(sizes) - sizes + most
        order = np.lexsort((at, doc))
        doc, at, least, most, place = doc[order], at[order].astype(np.int64), least[order], most[order], place[order]
        starts, ends, owners = [known_start], [known_end], [known_doc]
        grams = np.ascontiguousarray(body[place[:, None] + np.arange(GRAM)]).view(f"S{GRAM}").ravel() if len(place) else np.zeros(0, f"S{GRAM}")
        by_gram = np.argsort(grams, kind="stable")
        cuts = np.flatnonzero(np.r_[True, grams[by_gram[1:]] != grams[by_gram[:-1]]]) if len(grams) else np.zeros(0, np.int64)
        edges = np.unique(cuts[np.minimum(np.searchsorted(cuts, np.arange(0, len(grams), 20_000)), len(cuts) - 1)]) if len(cuts) else cuts
        bounds = [*edges.tolist(), len(grams)]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            rows = np.sort(by_gram[a:b])
            marks = mark_repeats(body, place[rows], least[rows], most[rows], doc[rows], at[rows])
            hit, lo, hi = stretches(marks)
            hit = rows[hit]
            starts.append((at[hit] - hi).astype(np.int32))
            ends.append((at[hit] - lo + LENGTH).astype(np.int32))
            owners.append(doc[hit])
        pairs = np.stack([np.concatenate(starts), np.concatenate(ends)], axis=1).astype(np.int32)
        return by_document(np.concatenate(owners), pairs, buckets)

    with_places = source.join(places, "doc_id")
    dealt = with_places.mapInArrow(
        deal, "bucket int, doc binary, at binary, least binary, most binary, body binary, known_doc binary, known_start binary, known_end binary"
    )
    return gathered(dealt.groupBy("bucket").applyInArrow(sort, PACKED), "spans")


def cut_spans(batches: Iterator[pa.RecordBatch], whole_characters: bool, keep: Sequence[str] = ()) -> Iterator[pa.RecordBatch]:
    """Merges each document's spans and cuts them out of its bytes, or out of its characters where all bytes are covered. The columns ``keep`` follow as they are."""
    for batch in batches:
        for part in slices(batch, "text"):
            data, bounds = text_buffer(filled(part.column("text")))
            change = np.zeros(len(data) + 1, np.int32)
            for base, end, blob in zip(bounds[:-1].tolist(), bounds[1:].tolist(), part.column("spans").to_pylist(), strict=True):
                if blob:
                    pairs = np.frombuffer(blob, np.int32).reshape(-1, 2) + base
                    pairs = pairs[pairs[:, 1] <= end]
                    np.add.at(change, pairs[:, 0], 1)
                    np.add.at(change, pairs[:, 1], -1)
            gone = np.cumsum(change)[:-1] > 0
            if whole_characters and len(data):
                heads = np.flatnonzero((data & 0xC0) != 0x80)
                gone = np.repeat(np.logical_and.reduceat(gone, heads), np.diff(np.r_[heads, len(data)]))
            raw = data.tobytes()
            kept, spans = [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                own = gone[a:b]
                if own.any():
                    edge = np.diff(np.r_[0, own.astype(np.int8), 0])
                    spans.append([{"start": s, "end": e} for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)])
                    kept.append(data[a:b][~own].tobytes())
                else:
                    spans.append([])
                    kept.append(raw[a:b])
            yield pa.RecordBatch.from_arrays(
                [id_array(ids(part.column("own_id"))), pa.array(np.diff(bounds), pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary()), *(part.column(f"keep_{c}") for c in keep)],
                ["doc_id", "n_bytes", "spans", "kept", *(f"keep_{c}" for c in keep)],
            )


def suffix_dedup(docs: DataFrame, text: str = "text", id_col: str = "doc_id", whole_characters: bool = False, one_text: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for every document, and ``keep_c`` for each column c of ``keep``, which spares a join.

    ``spans`` are the maximal runs of bytes covered by a ``LENGTH``-byte string that also starts earlier (in a smaller id, or before in
    the same document); ``kept`` is what is left. With ``whole_characters`` a character goes only if all of its bytes are covered, so that
    ``kept`` stays UTF-8. Null and empty texts are kept as no bytes. A null id is the lowest. Rows that
    repeat an id and its text are read as the same document given again: they are not compared with each other and get equal results.
    Different texts of one id are documents of their own, in the order of their SHA-256. ``one_text`` says that no id has two texts, so
    that this is not looked for. Other columns are not read.
    """
    others = [F.col(c).alias(f"keep_{c}") for c in keep]
    docs = docs.select(F.col(id_col).alias("own_id"), F.col(text).cast("string").alias("text"), *others)
    source = keyed(docs, "own_id", "text", *(f"keep_{c}" for c in keep)).withColumn("own_id", F.col("doc_id"))
    if not one_text:
        source = row_keys(source.drop("doc_id"), "own_id", "text", "doc_id")[0]
    total, size = source.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    buckets = max(partitions(docs.sparkSession), size // (8 << 20) + 1)
    places = written(repeated_grams(source, buckets), "repeated-grams")
    thin, often = sampled_grams(source, total, size)
    grams = np.sort(np.array(thin, dtype=f"S{GRAM}"))
    splitters = np.unique(grams[np.linspace(0, len(grams) - 1, min(buckets, len(grams)) + 1).astype(int)[1:-1]]) if len(grams) else grams
    frequent = np.sort(np.array(often, dtype=f"S{GRAM}"))
    spans = marked_spans(source, places, splitters, frequent, buckets)
    # the texts are dealt by their id once, for this join and for that with the places
    schema = StructType.fromDDL("doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
    for c in keep:
        schema.add(f"keep_{c}", source.schema[f"keep_{c}"].dataType)
    return source.join(spans, "doc_id", "left").mapInArrow(lambda batches: cut_spans(batches, whole_characters, keep), schema)


def removal_report(cut: DataFrame) -> DataFrame:
    """The digest columns of ``suffix_dedup``."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
