"""Token counts by finite-state transducers, without running the tokenizer.

A byte-level BPE tokenizer is compiled into two deterministic transducers. The first reads character
classes and marks where pieces begin (contractions, an optional blank before a run of letters, digits or
other marks, white space that hands its last character on). Its thirteen states are few enough to run each
chunk of text from every state at once: a chunk becomes a map from states to states, the maps compose
in a parallel prefix scan, and so each chunk learns its true start state however long the text is. The second
reads the bytes of a piece; each transition carries the number of tokens it adds to the encoding of what
was read so far. Its states are built when first reached and thrown away when there are too many.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobweave.llm.common import filled, slices, worker_cache

END, SPACE, BLANK, LETTER, DIGIT, OTHER, QUOTE = range(7)
#: Letters that a contraction may hold; fixed values of the tokenizer's pattern.
SHORT = "stmd"
LONG = {"r": "e", "v": "e", "l": "l"}
SPECIAL_LETTERS = "stmdrvel"
CLASSES = 7 + len(SPECIAL_LETTERS)
STATES = 13
START, IN_LETTERS, IN_DIGITS, IN_OTHER, ONE_SPACE, RUN_SPACE, ONE_BLANK, RUN_BLANK, QUOTED, AFTER_R, AFTER_V, AFTER_L, DONE = range(13)
CHUNK = 128
CUT_HERE, CUT_BEFORE = 1, 2


def class_table() -> np.ndarray:
    """The class of each code point."""
    import regex

    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", DIGIT), (r"\s+", BLANK)):
        for run in regex.finditer(pattern, every):
            text = run.group()
            table[np.frombuffer(text.encode("utf-32-le"), np.uint32)] = kind
    table[32] = SPACE
    table[39] = QUOTE
    for n, letter in enumerate(SPECIAL_LETTERS):
        table[ord(letter)] = 7 + n
    return table


def compile_pieces() -> tuple[np.ndarray, np.ndarray]:
    """Next state and cut marks for each state and class."""
    goes = np.zeros((STATES, CLASSES), np.uint8)
    cuts = np.zeros((STATES, CLASSES), np.uint8)
    for state in range(STATES):
        for kind in range(CLASSES):
            letter = SPECIAL_LETTERS[kind - 7] if kind >= 7 else ""
            broad = LETTER if letter else kind
            fresh = {END: START, SPACE: ONE_SPACE, BLANK: ONE_BLANK, LETTER: IN_LETTERS, DIGIT: IN_DIGITS, OTHER: IN_OTHER, QUOTE: QUOTED}[broad]
            to, cut = fresh, CUT_HERE
            runs = {LETTER: IN_LETTERS, DIGIT: IN_DIGITS, OTHER: IN_OTHER, QUOTE: IN_OTHER}
            if broad == END:
                cut = CUT_HERE | (CUT_BEFORE if state in (AFTER_R, AFTER_V, AFTER_L) else 0)
            elif state in (IN_LETTERS, IN_DIGITS, IN_OTHER):
                if runs.get(broad) == state:
                    to, cut = state, 0
            elif state in (ONE_SPACE, RUN_SPACE):
                if broad in runs:
                    to, cut = runs[broad], 0 if state == ONE_SPACE else CUT_BEFORE
                else:
                    to, cut = RUN_SPACE if broad == SPACE else RUN_BLANK, 0
            elif state in (ONE_BLANK, RUN_BLANK):
                if broad in (SPACE, BLANK):
                    to, cut = RUN_SPACE if broad == SPACE else RUN_BLANK, 0
                elif state == RUN_BLANK:
                    cut = CUT_HERE | CUT_BEFORE
            elif state == QUOTED:
                if letter and letter in SHORT:
                    to, cut = DONE, 0
                elif letter in LONG:
                    to, cut = {"r": AFTER_R, "v": AFTER_V, "l": AFTER_L}[letter], 0
                elif broad in (OTHER, QUOTE):
                    to, cut = IN_OTHER, 0
            elif state in (AFTER_R, AFTER_V, AFTER_L):
                wanted = {AFTER_R: "e", AFTER_V: "e", AFTER_L: "l"}[state]
                if letter == wanted:
                    to, cut = DONE, 0
                elif broad == LETTER:
                    to, cut = IN_LETTERS, CUT_BEFORE
                else:
                    cut = CUT_HERE | CUT_BEFORE
            goes[state, kind], cuts[state, kind] = to, cut
    return goes, cuts


def piece_starts(kinds: np.ndarray, goes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Positions at which pieces begin, by chunk maps and a prefix scan over them."""
    n = len(kinds)
    chunks = -(-n // CHUNK)
    grid = np.zeros((chunks, CHUNK), np.uint8)
    grid.reshape(-1)[:n] = kinds
    by_step = np.ascontiguousarray(grid.T).astype(np.intp)
    flat_goes = (goes.astype(np.intp) * CLASSES).reshape(-1)
    maps = np.repeat(np.arange(STATES, dtype=np.intp)[:, None] * CLASSES, chunks, axis=1)
    for step in range(CHUNK):
        maps = flat_goes[maps + by_step[step]]
    maps //= CLASSES
    reach = 1
    while reach < chunks:
        later = np.take_along_axis(maps[:, reach:], maps[:, :-reach], axis=0)
        maps = np.concatenate([maps[:, :reach], later], axis=1)
        reach *= 2
    state = np.zeros(chunks, np.intp)
    state[1:] = maps[START, :-1] * CLASSES
    flat_cuts = cuts.reshape(-1)
    marks = np.zeros((CHUNK, chunks), np.uint8)
    for step in range(CHUNK):
        at = state + by_step[step]
        marks[step] = flat_cuts[at]
        state = flat_goes[at]
    marks = np.ascontiguousarray(marks.T).reshape(-1)[:n]
    begins = (marks & CUT_HERE) > 0
    begins[:-1] |= (marks[1:] & CUT_BEFORE) > 0
    return np.flatnonzero(begins)


def printable_bytes() -> dict[str, int]:
    """The byte behind each printable stand-in of a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(hidden)}


class PieceTransducer:
    """Counts the BPE tokens of a piece from left to right.

    The encoding of a prefix ends in exactly one token such that the rest of the prefix is encoded as before and the two
    tokens at the seam would not have merged otherwise; so a state (a prefix) knows its last token and its
    number of tokens, and a transition the difference between two numbers.
    """

    MOST_STATES, MOST_PIECES, LONG_PIECE = 300_000, 500_000, 48

    def __init__(self, path: str):
        model = json.loads(open(path, encoding="utf-8").read())
        real = printable_bytes()
        as_bytes = lambda token: bytes(real[c] for c in token)
        self.special = [t["content"] for t in model["added_tokens"]]
        plain = [t for t in model["model"]["vocab"] if t not in set(self.special)]
        self.tokens = {as_bytes(t) for t in plain}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.ranks = {(as_bytes(a), as_bytes(b)): n for n, (a, b) in enumerate(merges)}
        self.made_by = {a + b: (rank, (a, b)) for (a, b), rank in reversed(self.ranks.items())}
        self.edge_parts: tuple[dict, dict] = ({}, {})
        self.longest = max(map(len, self.tokens))
        self.seams: dict[tuple[bytes, bytes], bool] = {}
        self.counted: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.edges: dict[int, int] = {}
        self.last: list[bytes] = [b""]
        self.total: list[int] = [0]

    def _edge_parts(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """The parts that stand at one edge of a token while it is merged, with the rank that ends each."""
        known = self.edge_parts[side].get(token)
        if known is None:
            whole, until, known = token, 1 << 60, []
            while True:
                known.append((whole, until))
                if len(whole) == 1:
                    break
                until, pair = self.made_by[whole]
                whole = pair[side]
            known.reverse()
            self.edge_parts[side][token] = known
        return known

    def holds(self, left: bytes, right: bytes) -> bool:
        """Whether the two tokens side by side are encoded as just these two: no pair at the seam merges in time."""
        known = self.seams.get((left, right))
        if known is None:
            lefts, rights, i, j, known = self._edge_parts(left, 1), self._edge_parts(right, 0), 0, 0, True
            while True:
                (a, a_ends), (b, b_ends) = lefts[i], rights[j]
                rank = self.ranks.get((a, b))
                if rank is not None and rank < a_ends and rank <= b_ends:
                    known = False
                    break
                if a_ends == b_ends == 1 << 60:
                    break
                i, j = (i + 1, j) if a_ends <= b_ends else (i, j + 1)
            if len(self.seams) > 500_000:
                self.seams.clear()
            self.seams[left, right] = known
        return known

    def _last_token(self, raw: bytes, to: int, last_of) -> bytes:
        for size in range(min(self.longest, to), 0, -1):
            token = raw[to - size : to]
            if token in self.tokens:
                before = last_of(to - size)
                if not before or self.holds(before, token):
                    return token
        raise ValueError("the vocabulary lacks a byte")

    def count(self, piece: str) -> int:
        found = self.counted.get(piece)
        if found is not None:
            return found
        raw = piece.encode("utf-8")
        if len(raw) > self.LONG_PIECE:
            last, total = [b""], [0]
            for to in range(1, len(raw) + 1):
                token = self._last_token(raw, to, last.__getitem__)
                last.append(token)
                total.append(total[to - len(token)] + 1)
            return total[-1]
        if len(self.last) > self.MOST_STATES:
            self._clear()
        path = [0]
        for to, byte in enumerate(raw, 1):
            edge = path[-1] << 8 | byte
            state = self.edges.get(edge)
            if state is None:
                token = self._last_token(raw, to, lambda i: self.last[path[i]])
                state = self.edges[edge] = len(self.last)
                self.last.append(token)
                self.total.append(self.total[path[to - len(token)]] + 1)
            path.append(state)
        if len(self.counted) > self.MOST_PIECES:
            self.counted.clear()
        found = self.counted[piece] = self.total[path[-1]]
        return found


def count_texts(texts: list[str], machine: PieceTransducer, table: np.ndarray, goes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Token counts of the texts."""
    joined = "\0".join(texts) + "\0"
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    kinds = table[np.frombuffer(joined.encode("utf-32-le"), np.uint32)]
    kinds[ends] = END
    tokens = np.zeros(len(texts), np.int64)
    for special in machine.special:
        at = joined.find(special)
        while at >= 0:
            kinds[at : at + len(special)] = END
            tokens[np.searchsorted(ends, at)] += 1
            at = joined.find(special, at + len(special))
    starts = piece_starts(kinds, goes, cuts)
    stops = np.append(starts[1:], len(kinds))
    real = kinds[starts] != END
    starts, stops = starts[real], stops[real]
    get, count = machine.counted.get, machine.count
    each = np.fromiter(
        (get(p) or count(p) for p in (joined[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True))),
        np.int64,
        len(starts),
    )
    return tokens + np.bincount(np.searchsorted(ends, starts), each, len(texts)).astype(np.int64)


def token_counts(docs: DataFrame, tokenizer_path: str, text: str = "text", id_col: str = "doc_id", limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every whole text.

    A null or empty text has no bytes and no tokens. Rows are counted one by one: repeated rows and null ids come
    out as they went in, other columns are not read. The count is that of the tokenizer file at ``tokenizer_path`` (byte-level
    BPE with the pattern of the module's first transducer); special strings count one and part the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = worker_cache("token_classes", class_table)
        machine = worker_cache("token_machine " + tokenizer_path, lambda: PieceTransducer(tokenizer_path))
        goes, cuts = compile_pieces()
        for batch in batches:
            for part in slices(batch, "text"):
                texts = filled(part.column("text")).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(count_texts(texts, machine, table, goes, cuts), pa.int64()), part.column("n_bytes")],
                    ["doc_id", "n_tokens", "n_bytes"],
                )

    source = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"),
    )
    counted = source.mapInArrow(run, "doc_id long, n_tokens long, n_bytes long")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
