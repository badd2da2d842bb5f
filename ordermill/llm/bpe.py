"""BPE encoding and decoding with a contiguous array of ranks per word.

A short word is held as an array of parts and an array of the ranks of
adjacent parts. The smallest rank is found by a scan, its boundary deleted,
and the two neighbouring ranks are looked up anew, until no rank is left. The
scans run over many words of one length at a time.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from ordermill.llm import textkit

NONE = np.int32(2**31 - 1)
#: Longer words are merged with a heap, as the scans would take the square of the length.
SHORT = 64
#: Words whose ids a task remembers at most; the memory is then begun anew.
REMEMBERED = 200_000
MARK, LETTER, DIGIT, SPACE = range(4)
#: Code points of the planes that hold characters with a class of their own; all later ones are marks.
CLASSED = 0x40000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if it is visible, else one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(rest)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of a word-end BPE vocabulary in the tokenizers library's JSON format.

    Supported: BPE with an end-of-word suffix over byte-level symbols, an NFC,
    white space and lower-case normaliser, a splitting pattern whose matches
    are the words, and special tokens that are found in the raw text.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        symbols = byte_symbols()
        self.inner = np.array([vocab[c] for c in symbols], np.int32)
        self.final = np.array([vocab[c + suffix] for c in symbols], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 16 | vocab[b] for a, b in pairs], np.uint32)
        made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        _, first = np.unique(keys[::-1], return_index=True)  # of a repeated pair, the later rank holds
        rank = (len(keys) - 1 - first).astype(np.int32)
        self.keys, self.ranks, self.made = keys[rank], rank, made
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for t, i in (vocab | self.special).items():
            self.tokens[i] = t
        self.find_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.kind, self.endings = _classes(split["pattern"]["Regex"])
        self.known: dict[str, bytes] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.uint32) << np.uint32(16) | right.astype(np.uint32)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def _merge_short(self, parts: np.ndarray) -> list[bytes]:
        """Token ids of words of one length; ``parts`` has a row for each."""
        out: list[bytes] = [b""] * len(parts)
        row = np.arange(len(parts))
        ranks = self._rank(parts[:, :-1], parts[:, 1:])
        while len(row):
            width = parts.shape[1]
            if width > 1:
                at = ranks.argmin(axis=1)
                least = ranks[np.arange(len(row)), at]
                done = least == NONE
            else:
                done = np.ones(len(row), bool)
            if done.any():
                raw, size = np.ascontiguousarray(parts[done], "<u4").tobytes(), 4 * width
                for k, r in enumerate(row[done].tolist()):
                    out[r] = raw[k * size:(k + 1) * size]
                go = ~done
                row, parts, ranks = row[go], parts[go], ranks[go]
                if not len(row):
                    break
                at, least = at[go], least[go]
            i = np.arange(len(row))
            parts[i, at] = self.made[least]
            # Delete the boundary: the part after it, and the rank across it.
            col = np.arange(width - 1)
            parts = np.take_along_axis(parts, col + (col > at[:, None]), axis=1)
            col = np.arange(width - 2)
            ranks = np.take_along_axis(ranks, col + (col >= at[:, None]), axis=1)
            near = np.flatnonzero(at > 0)
            ranks[near, at[near] - 1] = self._rank(parts[near, at[near] - 1], parts[near, at[near]])
            near = np.flatnonzero(at < width - 2)
            ranks[near, at[near]] = self._rank(parts[near, at[near]], parts[near, at[near] + 1])
        return out

    def _merge_long(self, parts: np.ndarray) -> bytes:
        n = len(parts)
        ids, after, before = parts.tolist(), [*range(1, n), -1], [*range(-1, n - 1)]
        rank = self._rank(parts[:-1], parts[1:]).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(rank) if r != NONE]
        heapq.heapify(heap)
        alive = [True] * n

        def push(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (r := int(self._rank(np.array([ids[i]]), np.array([ids[j]]))[0])) != NONE:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = int(self.made[r]), False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            push(before[i], i)
            push(i, after[i])
        return np.array([t for t, on in zip(ids, alive, strict=True) if on], "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Work out and remember the ids of words."""
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for w in words:
            raw = w.encode("utf-8")
            by_length.setdefault(len(raw), []).append((w, raw))
        for size, group in by_length.items():
            raw = np.frombuffer(b"".join(r for _, r in group), np.uint8).reshape(-1, size)
            parts = self.inner[raw]
            parts[:, -1] = self.final[raw[:, -1]]
            ids = self._merge_short(parts) if size <= SHORT else [self._merge_long(p) for p in parts]
            self.known.update(zip([w for w, _ in group], ids, strict=True))

    def _plain(self, text: str) -> str:
        """The normalised text. White space is left as it is: no word holds any.

        A text with a character that the Unicode versions of Python and the library may treat otherwise is left to the library's normaliser.
        """
        if not text.isascii() and _unknown()[np.frombuffer(text.encode("utf-32-le"), "<u4")].any():
            return normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str(text)
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # Σ is folded without regard to its place

    def _words(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of the words in an array of code points: runs of letters or of
        other marks, single digits, and the contractions that begin a run of marks."""
        kind = self.kind[code]
        n = len(code)
        new = np.ones(n, bool)
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        apostrophe = np.flatnonzero((code == 0x27) & new)
        if len(apostrophe):
            taken = -1
            padded = np.append(code, [0, 0])
            again = apostrophe.tolist()
            for at in again:  # the list grows: a mark run may begin anew after a contraction
                if at < taken:
                    continue
                after = "".join(map(chr, padded[at + 1:at + 3]))
                ending = next((e for e in self.endings if after.startswith(e)), "")
                if ending:
                    taken = at + 1 + len(ending)
                    new[at + 1:taken] = False
                    if taken < n:
                        new[taken] = True
        start = np.flatnonzero(new)
        end = np.append(start[1:], n)
        word = kind[start] != SPACE
        return start[word], end[word]

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts in a row, and where each text's ids begin (and the last end)."""
        parts, begins, marks, size = [], [], [], 0
        for t in texts:
            begins.append(size)
            for p in self.find_special.split(t) if any(map(t.__contains__, self.special)) else (t,):
                if p in self.special:
                    marks.append((size, self.special[p]))
                    p = ""
                else:
                    p = self._plain(p)
                parts.append(p)
                size += len(p) + 1
        joined = "\n".join([*parts, ""])  # a break ends every word
        code = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        start, end = self._words(code)
        if len(self.known) > REMEMBERED:
            self.known = {}
        key = textkit.value_hash(lambda a, b: textkit.mix(code[a:b].astype(np.uint64) + np.uint64(1)), start, end)
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        distinct = [joined[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        self.learn({w for w in distinct if w not in self.known})
        ids = [self.known[w] for w in distinct]
        if marks:
            start = np.concatenate([start, np.array([m[0] for m in marks])])
            which = np.concatenate([which, len(ids) + np.arange(len(marks))])
            ids += [m[1].to_bytes(4, "little") for m in marks]
            order = np.argsort(start, kind="stable")
            start, which = start[order], which[order]
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        length = np.array([len(x) // 4 for x in ids], np.int64)
        source = np.cumsum(length) - length
        length, source = length[which], source[which]
        target = np.cumsum(length) - length
        total = int(length.sum())
        out = flat[np.repeat(source - target, length) + np.arange(total)]
        first_word = np.searchsorted(start, np.array([*begins, size]))
        return out, np.append(target, total)[first_word]

    def decode(self, ids: np.ndarray) -> str:
        """Text of token ids. The format names no decoder, so tokens are joined by spaces; unknown ids are skipped."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids.tolist() if i < len(tokens) and tokens[i]])


@functools.lru_cache(maxsize=1)
def _unknown() -> np.ndarray:
    """Code points that Python and the library may fold, order or compose otherwise, as they follow several Unicode
    versions: those that Python leaves unassigned, and marks that are not in both of Python's own versions (3.2 and the current)."""
    old = unicodedata.ucd_3_2_0
    out = np.zeros(0x110000, bool)
    for c in map(chr, range(0x110000)):
        now = unicodedata.category(c)
        out[ord(c)] = now == "Cn" or now[0] == "M" and (old.category(c) == "Cn" or old.combining(c) != unicodedata.combining(c))
    return out


@functools.lru_cache(maxsize=4)
def _classes(pattern: str) -> tuple[np.ndarray, list[str]]:
    """Kind of every code point, and the contractions, of a splitting pattern
    ``'x|'y|...|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+``.

    The classes are those of the library's own expressions, whatever Unicode version they follow.
    """
    *endings, letters, digit, marks = pattern.split("|")
    if (letters, digit, marks) != (r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+") or any(not e.startswith("'") for e in endings):
        raise ValueError(f"unsupported splitting pattern {pattern}")
    kind = np.full(0x110000, MARK, np.uint8)
    for pattern, k in ((r"\p{L}+", LETTER), (r"\p{N}+", DIGIT), (r"\s+", SPACE)):
        between = pre_tokenizers.Split(Regex(pattern), "removed")
        for lo in range(0, CLASSED, 0x2000):
            code = np.array([c for c in range(lo, lo + 0x2000) if not 0xD800 <= c < 0xE000])
            match = np.ones(len(code), bool)
            for _, (i, j) in between.pre_tokenize_str("".join(map(chr, code.tolist()))):
                match[i:j] = False
            kind[code[match]] = k
    return kind, [e[1:] for e in endings]


@functools.lru_cache(maxsize=4)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def _encoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            texts = batch.column("text")
            for s in textkit.slices(texts):
                flat, ends = bpe.encode_batch(texts.slice(s.lo, len(s)).fill_null("").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(s.lo, len(s)) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "text"),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))],
                    [*(n for n in batch.schema.names if n != "text"), "token_ids"])
    return run


def _decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            ids = batch.column("token_ids")
            flat = ids.values.to_numpy()
            off = ids.offsets.to_numpy()
            step = max(1, len(ids) // (1 + len(flat) // 500_000))  # some 500,000 ids at a time
            for lo in range(0, len(ids), step):
                hi = min(lo + step, len(ids))
                part = [flat[off[i]:off[i + 1]] for i in range(lo, hi)]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(lo, hi - lo) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "token_ids"),
                     pa.array([p.astype("<u4").tobytes() for p in part], pa.binary()), pa.array(map(bpe.decode, part), pa.string())],
                    [*(n for n in batch.schema.names if n != "token_ids"), "ids_le", "decoded"])
    return run


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Token ids of every text: ``key``, ``token_ids`` (array of int).

    ``path``: the vocabulary file, present on every executor. Reads ``key`` and
    ``text`` only, so other columns cannot clash. A null text counts as empty;
    an empty text has no ids. Rows are encoded each, repeated or not; a null
    key is passed on; an empty table gives an empty result. Texts are encoded
    whole at any length.
    """
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, "text").mapInArrow(_encoder(path), f"{key} {kind}, token_ids array<int>")


def decode_documents(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Text of every row's ``token_ids``: ``key``, ``n_tokens``, ``ids_le`` (the ids as
    little-endian 32-bit integers), ``decoded``. Null ids count as none."""
    kind = encoded.schema[key].dataType.simpleString()
    ids = encoded.select(key, F.size(F.coalesce("token_ids", F.array())).cast("long").alias("n_tokens"),
                         F.coalesce("token_ids", F.array().cast("array<int>")).alias("token_ids"))
    return ids.mapInArrow(_decoder(path), f"{key} {kind}, n_tokens long, ids_le binary, decoded string")
