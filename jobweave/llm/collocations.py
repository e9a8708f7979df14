"""Phrase collocations of a corpus, per language, by Rabin-Karp fingerprints.

Texts are cut into pieces and words. Prefix polynomials over bytes give every word a hash, prefix polynomials over word hashes give
every run of one to three words a fingerprint. Documents are dealt into slices by a hash. A slice counts its fingerprints, compares all occurrences
of one with the first, and sends for each a count and a pointer (word and length), packed by ranges of fingerprints. Fingerprints that are frequent over all
slices send their pointers back to the slices, where the words are read, and only there do phrases become text. Counts are summed by the text itself, so
two phrases that share a fingerprint stay apart; 40 bits of it within a range are enough.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobweave.llm.common import LOWER, NULL_ID, SLICE_BYTES, byte_codes, filled, mix, packed, partitions, prefix_hashes, slices, text_buffer, unpacked, words_of, written

UNKNOWN = "und"
WORDS = 3
#: Bytes that end a piece, and bytes that part words (blank, tab and those that end a piece).
PIECE_END = np.isin(np.arange(256), np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))
PARTS = PIECE_END | np.isin(np.arange(256), [9, 32])
#: Parts that a language's last ranking is cut into before the parts are ranked together.
RANK_PARTS = 64


def gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of the runs, one after the other."""
    heads = np.cumsum(lengths) - lengths
    return data[np.arange(int(lengths.sum())) + np.repeat(starts - heads, lengths)]


def numbered_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A number for each word, the same for the same bytes and for these only: by hash, and by the bytes if a hash stands for two words."""
    if not len(starts):
        return np.zeros(0, np.int64)
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    lengths, model = ends - starts, first[number]
    if np.array_equal(lengths, lengths[model]) and np.array_equal(gathered(data, starts, lengths), gathered(data, starts[model], lengths)):
        return number
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(data[a:b].tobytes(), len(known)) for a, b in zip(starts, ends, strict=True)], np.int64)


class Piecewise:
    """The words of a run of texts, their hashes, and for each word how many words follow in its piece, itself included (at most ``WORDS``)."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        self.data, self.bounds = LOWER[data], bounds
        self.starts, self.ends, self.before = words_of(self.data, bounds, PARTS)
        self.row = np.repeat(np.arange(len(bounds) - 1), np.diff(self.before))
        codes = byte_codes()[self.data]
        self.hashes = mix(prefix_hashes(codes, self.starts, self.ends) + (self.ends - self.starts).astype(np.uint64))
        piece = np.cumsum(PIECE_END[self.data])[self.starts] + self.row if len(self.starts) else np.zeros(0, np.int64)
        self.room = np.ones(len(self.starts), np.int64)
        for n in range(1, WORDS):
            self.room[:-n] += (piece[n:] == piece[:-n]) if len(piece) > n else 0

    def fingerprints(self, at: np.ndarray, n: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Of the run of ``n`` words from each place on, under a code for the language."""
        return mix(prefix_hashes(self.hashes, at, at + n) + mix(code + n.astype(np.uint64))).view(np.int64)


def language_codes(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each row the number of its language in this run, and a 64-bit code that is the same in every run."""
    coded = names.dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    codes = [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in coded.dictionary.to_pylist()]
    return number, np.array(codes, np.uint64)[number] if len(number) else np.zeros(0, np.uint64)


def stretches(table: pa.Table, most: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, bytes and bounds, in runs of about ``most`` bytes. A longer text comes alone, cut behind a piece's end.

    No phrase crosses the end of a piece, so none is lost. A text without such an end within ``most`` bytes goes on to its next one.
    """
    row = 0
    for batch in table.select(["text"]).combine_chunks().to_batches():
        for part in slices(batch, "text", most):
            data, bounds = text_buffer(filled(part.column("text")))
            to = row + part.num_rows
            if part.num_rows > 1 or len(data) <= most:
                yield row, to, data, bounds
            else:
                cuts = np.flatnonzero(PIECE_END[data]) + 1
                at = 0
                while at < len(data):
                    place = int(np.searchsorted(cuts, at + most, "right")) - 1
                    if place < 0 or cuts[place] <= at:
                        place += 1
                    end = int(cuts[place]) if at + most < len(data) and place < len(cuts) else len(data)
                    yield row, to, data[at:end], np.array([0, end - at])
                    at = end
            row = to


def in_order(table: pa.Table) -> pa.Table:
    """The rows of a slice in one order, whatever order they came in, so that a pointer means the same whenever a slice is read."""
    return table.sort_by([("doc_id", "ascending"), ("digest", "ascending")])


def _counted(words: Piecewise, language: np.ndarray, code: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each distinct run of words per language: fingerprint, first place, number of words, and occurrences, all compared with the first."""
    n = np.repeat(np.arange(1, WORDS + 1), [int((words.room >= k).sum()) for k in range(1, WORDS + 1)])
    at = np.concatenate([np.flatnonzero(words.room >= k) for k in range(1, WORDS + 1)])
    row = words.row[at]
    prints = words.fingerprints(at, n, code[row])
    shown, first, group = np.unique(prints, return_index=True, return_inverse=True)
    number = np.r_[numbered_words(words.data, words.starts, words.ends, words.hashes), np.full(WORDS, -1)]

    def exact() -> Iterator[np.ndarray]:
        yield language[row]
        yield n
        for k in range(WORDS):
            yield np.where(n > k, number[at + k], -1)

    model = first[group]
    if not all(np.array_equal(c, c[model]) for c in exact()):
        _, first, group = np.unique(np.stack(list(exact()), axis=1), axis=0, return_index=True, return_inverse=True)
        shown = prints[first]
    return shown, at[first], n[first], np.bincount(group.ravel(), times[row], len(first)).astype(np.int64)


def count_pointers(docs: DataFrame, ranges: int, most: int) -> DataFrame:
    """``part, slice, prints, counts, pointers``: the distinct runs of words of each slice, in ranges of their fingerprints.

    A pointer is the number of a word within the slice and how many words follow from there.
    """
    kinds = {"part": pa.int32(), "slice": pa.int32(), "prints": pa.binary(), "counts": pa.binary(), "pointers": pa.binary()}

    def count(table: pa.Table) -> pa.Table:
        found: list[tuple] = []
        number, passed = table.column("slice")[0].as_py(), 0
        table = in_order(table)
        times, names = table.column("times").to_numpy(), table.column("lang").combine_chunks()
        for a, b, data, bounds in stretches(table, most):
            words = Piecewise(data, bounds)
            prints, at, n, counts = _counted(words, *language_codes(names[a:b]), times[a:b])
            prints, pointers = prints.view(np.uint64), (at + passed) * 4 + n
            passed += len(words.starts)
            place = ((prints >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            short = prints & np.uint64((1 << 40) - 1)
            order = np.lexsort((short, place))
            place, short, counts, pointers = place[order], short[order], counts[order], pointers[order]
            cuts = np.searchsorted(place, np.arange(ranges + 1)).tolist()
            found += [
                (part, number, packed(np.diff(short[x:y], prepend=np.uint64(0))), packed(counts[x:y]), packed(pointers[x:y]))
                for part, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if x < y
            ]
        return pa.table({k: pa.array([f[i] for f in found], t) for i, (k, t) in enumerate(kinds.items())})

    return docs.groupBy("slice").applyInArrow(count, "part int, slice int, prints binary, counts binary, pointers binary")


def frequent_pointers(counted: DataFrame, least: int) -> DataFrame:
    """The pointers and counts whose fingerprint occurs ``least`` times or more over all slices."""

    def keep(table: pa.Table) -> pa.Table:
        prints = [np.cumsum(unpacked(b)) for b in table.column("prints").to_pylist()]
        counts = [unpacked(b) for b in table.column("counts").to_pylist()]
        ends = np.cumsum([len(p) for p in prints])
        _, group = np.unique(np.concatenate(prints), return_inverse=True)
        often = (np.bincount(group.ravel(), np.concatenate(counts)) >= least)[group.ravel()]
        chosen = [often[e - len(p) : e] for e, p in zip(ends.tolist(), prints, strict=True)]
        some = [i for i, c in enumerate(chosen) if c.any()]
        blobs = table.column("pointers").to_pylist()
        return pa.table({
            "part": table.column("part").take(pa.array(some, pa.int64())), "slice": table.column("slice").take(pa.array(some, pa.int64())),
            "counts": pa.array([packed(counts[i][chosen[i]]) for i in some], pa.binary()), "pointers": pa.array([packed(unpacked(blobs[i])[chosen[i]]) for i in some], pa.binary()),
        })

    return counted.groupBy("part").applyInArrow(keep, "part int, slice int, counts binary, pointers binary")


def read_pointers(docs: DataFrame, pointers: DataFrame, ranges: int, most: int) -> DataFrame:
    """``part, lang, phrases, counts``: what the pointers of each slice lead to, sorted and packed; all words of a language count under the empty phrase."""
    import zstandard

    kinds = {"part": pa.int32(), "lang": pa.string(), "phrases": pa.binary(), "counts": pa.binary()}

    def read(table: pa.Table, wanted: pa.Table) -> pa.Table:
        table = in_order(table)
        times, names = table.column("times").to_numpy(), table.column("lang").combine_chunks()
        each = [unpacked(b).astype(np.int64) for b in wanted.column("pointers").to_pylist()]
        none = [np.zeros(0, np.int64)]
        pointer = np.concatenate([*each, *none])
        part = np.repeat(np.array(wanted.column("part").to_pylist(), np.int64), [len(x) for x in each])
        count = np.concatenate([*(unpacked(b).astype(np.int64) for b in wanted.column("counts").to_pylist()), *none])
        order = np.argsort(pointer, kind="stable")
        pointer, part, count = pointer[order], part[order], count[order]
        passed, found = 0, []
        for a, b, data, bounds in stretches(table, most):
            words = Piecewise(data, bounds)
            x, y = np.searchsorted(pointer, [passed * 4, (passed + len(words.starts)) * 4]).tolist()
            at = pointer[x:y] // 4 - passed
            passed += len(words.starts)
            language, code = language_codes(names[a:b])
            found.append(pa.table({"part": part[x:y], "lang": names[a:b].take(pa.array(words.row[at])), "phrase": _phrases(words, at, pointer[x:y] % 4), "count": count[x:y]}))
            kind, where = np.unique(language, return_index=True)
            total = np.bincount(language[words.row], times[a:b][words.row], len(kind)).astype(np.int64)
            found.append(pa.table({"part": (code[where] % np.uint64(ranges)).astype(np.int64), "lang": names[a:b].take(pa.array(where)), "phrase": pa.array([""] * len(where), pa.string()), "count": total}))
        if not found:
            return pa.table({k: pa.array([], t) for k, t in kinds.items()})
        rows = pa.concat_tables(found).sort_by([("part", "ascending"), ("lang", "ascending"), ("phrase", "ascending")]).combine_chunks()
        key = rows.column("part").to_numpy() * rows.num_rows + pc.rank(rows.column("lang").combine_chunks(), tiebreaker="dense").to_numpy()
        cuts = [*np.flatnonzero(np.r_[True, key[1:] != key[:-1]]).tolist(), rows.num_rows] if rows.num_rows else [0]
        out, squeeze = [], zstandard.ZstdCompressor(level=3)
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            # no phrase holds a line's end
            text = "\n".join(rows.column("phrase")[x:y].to_pylist()).encode()
            out.append((rows.column("part")[x].as_py(), rows.column("lang")[x].as_py(), squeeze.compress(text), packed(rows.column("count")[x:y].to_numpy())))
        return pa.table({k: pa.array([r[i] for r in out], t) for i, (k, t) in enumerate(kinds.items())})

    return docs.groupBy("slice").cogroup(pointers.groupBy("slice")).applyInArrow(read, "part int, lang string, phrases binary, counts binary")


def sum_phrases(found: DataFrame, least: int) -> DataFrame:
    """``lang, phrase, n, a`` of the phrases whose counts come to ``least`` or more, and of the empty phrase of each language."""
    import zstandard

    def add(table: pa.Table) -> pa.Table:
        languages, phrases, counts = [], [], []
        for lang, blob, count in zip(*(table.column(c).to_pylist() for c in ("lang", "phrases", "counts")), strict=True):
            own = zstandard.ZstdDecompressor().decompress(blob).decode().split("\n")
            phrases.append(pa.array(own, pa.string()))
            languages.append(pa.array([lang] * len(own), pa.string()))
            counts.append(pa.array(unpacked(count).astype(np.int64)))
        rows = pa.table({"lang": pa.concat_arrays(languages), "phrase": pa.concat_arrays(phrases), "a": pa.concat_arrays(counts)})
        rows = rows.group_by(["lang", "phrase"]).aggregate([("a", "sum")])
        rows = rows.filter(pc.or_(pc.greater_equal(rows.column("a_sum"), least), pc.equal(rows.column("phrase"), "")))
        n = pc.if_else(pc.equal(rows.column("phrase"), ""), 0, pc.add(pc.count_substring(rows.column("phrase"), " "), 1))
        return pa.table({"lang": rows.column("lang"), "phrase": rows.column("phrase"), "n": pc.cast(n, pa.int32()), "a": rows.column("a_sum")})

    return found.groupBy("part").applyInArrow(add, "lang string, phrase string, n int, a long")


def _phrases(words: Piecewise, place: np.ndarray, n: np.ndarray) -> pa.Array:
    """The words of each run, joined by one blank."""
    first = np.cumsum(n) - n
    each = np.arange(int(n.sum())) - np.repeat(first - place, n)
    starts, lengths = words.starts[each], words.ends[each] - words.starts[each] + 1
    # a word is copied with the byte behind it, which becomes the blank; the last word's goes
    padded = np.r_[words.data, np.uint8(32)]
    raw = gathered(padded, starts, lengths)
    ends = np.cumsum(lengths)
    raw[ends - 1] = 32
    last = np.r_[first[1:], len(each)] - 1 if len(first) else first
    keep = np.ones(len(raw), bool)
    keep[ends[last] - 1] = False
    sizes = np.add.reduceat(lengths, first) - 1 if len(first) else first
    bounds = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(n), [None, pa.py_buffer(bounds), pa.py_buffer(raw[keep].tobytes())])


def phrase_counts(docs: DataFrame, text: str = "text", id_col: str = "doc_id", lang: str = "lang", least: int = 10, most: int = SLICE_BYTES) -> DataFrame:
    """``lang, phrase, n, a``: every run of one to three words that occurs ``least`` times or more in a language, and under ``n`` 0 the language's number of words.

    Rows may repeat and ids may be null or shared: rows that are equal in id, language and text are counted as one, so often as they occur. Null languages
    count as ``und``, null texts have no words; other columns are not read.
    """
    body, name = F.col(text).cast("string"), F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN))
    keyed = docs.where(body.isNotNull()).select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.xxhash64(name, body).alias("digest"), name.alias("lang"), body.alias("text")
    )
    each = keyed.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    repeats, size = each.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    if repeats > 1:
        single = keyed.groupBy("doc_id", "digest", "lang", "text").agg(F.count(F.lit(1)).alias("times"))
    else:
        single = keyed.withColumn("times", F.lit(1).cast("long"))
    ranges = max(partitions(docs.sparkSession), size // (16 << 20) + 1)
    sliced = single.withColumn("slice", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(size // most + 1)).cast("int"))
    pointers = frequent_pointers(count_pointers(sliced, ranges, most), least)
    return sum_phrases(read_pointers(sliced, pointers, ranges, most), least)


def association(a: str, left: str, right: str) -> Column:
    """``floor(1000000 a a / (l r))``, exact up to counts of 10^15."""
    wide = [f"CAST({c} AS DECIMAL(15, 0))" for c in (a, left, right)]
    return F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * ({wide[0]} * {wide[0]})) div ({wide[1]} * {wide[2]})")


def collocations(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", lang: str = "lang", least: int = 10, covered: int = 50, top: int = 2000, most: int = SLICE_BYTES
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases of two or three words.

    A phrase's score is that of its weakest cut. A phrase inside a longer candidate goes if the longer one has ``covered`` hundredths of its
    occurrences or more. Ties are ordered by count and by the phrase's bytes. Texts without a phrase that occurs ``least`` times give no row.
    """
    counts = written(phrase_counts(docs, text, id_col, lang, least, most), "phrase-counts")
    candidates = counts.where("n >= 2")
    one = lambda side: counts.where("n > 0").select("lang", F.col("phrase").alias(side), F.col("a").alias(side[0]))
    tail = "substring(phrase, length(substring_index(phrase, ' ', {0})) + 2)"
    cut = F.expr(f"""explode(transform(sequence(1, n - 1), k -> named_struct(
        'k', k, 'left', substring_index(phrase, ' ', k), 'right', {tail.format('k')})))""")
    cuts = candidates.select("lang", "phrase", "n", "a", cut.alias("cut")).select("lang", "phrase", "n", "a", "cut.*")
    scored = cuts.join(one("left"), ["lang", "left"]).join(one("right"), ["lang", "right"]).withColumn("score", association("a", "l", "r"))
    weakest = scored.groupBy("lang", "phrase").agg(F.min_by(F.struct("n", "a", "l", "r", "score"), F.struct("score", "k")).alias("w")).select("lang", "phrase", "w.*")
    inside = F.explode(F.array(F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2)))
    longer = candidates.where("n = 3").select("lang", inside.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = weakest.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # each part of a language is ranked by itself first, so that one task sees at most RANK_PARTS * top rows of a language
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = kept.withColumn("_part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    sizes = counts.where("n = 0").select("lang", F.col("a").alias("n"))
    return ranked.drop("n").join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
