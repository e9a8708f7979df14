"""Plain versions of the operators: everything in memory, no cleverness."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def lowered(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def removed_bytes(docs: list[tuple[int, str | None]], length: int = 100) -> dict[int, tuple[int, int, int, str]]:
    """``n_bytes, n_removed, n_spans, kept_sha256`` by id."""
    seen, out = set(), {}
    for name, text in sorted(docs, key=lambda d: d[0]):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                gone[i : i + length] = [True] * length
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[name] = len(raw), len(raw) - len(kept), spans, sha(kept)
    return out


def shingles(text: str | None, size: int = 3) -> set[tuple[str, ...]]:
    words = WORD.findall(lowered(text or ""))
    if len(words) >= size:
        return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
    return {tuple(words)} if words else set()


def components(docs: list[tuple[int, str | None]], size: int = 3, least: int = 90) -> dict[int, tuple[int, int]]:
    """``n_shingles, component_id`` by id, for shingles of ``size`` words and ``least`` hundredths."""
    sets = {name: shingles(text, size) for name, text in docs}
    label = {name: name for name in sets}

    def root(x: int) -> int:
        while label[x] != x:
            x = label[x]
        return x

    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= least * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {name: (len(sets[name]), root(name)) for name in names}


def benchmark_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text or ""))


def contamination(docs: list[tuple[int, str | None]], items: list[tuple]) -> dict[int, tuple[int, int, int, str]]:
    """``n_words, n_hit, n_items, items_sha256`` by id."""
    windows: dict[tuple[str, ...], set[str]] = {}
    for name, text in items:
        words = benchmark_words(text)
        for i in range(max(1, len(words) - 9)):
            if words:
                windows.setdefault(tuple(words[i : i + 10]), set()).add(str(name))
    out = {}
    for name, text in docs:
        words, hit, found = benchmark_words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if own := windows.get(tuple(words[i : i + size])):
                    hit.update(range(i, i + size))
                    found |= own
        out[name] = len(words), len(hit), len(found), sha(",".join(sorted(found)))
    return out


def word_statistics(text: str | None) -> tuple[int, int, int, int, int, bool]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed``."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + n for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for n in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated),
        len(words) < 50 or 100 * len(repeated) > 50 * len(words),
    )
