"""BPE encoding and decoding by speculation and verification.

A word's encoding is guessed by greedy longest match. A sequence of pieces is the merge result exactly
when each piece encodes to itself and each adjacent pair of pieces encodes to that pair, so one lookup
for all adjacent pairs of a batch of words tells which guesses hold. Only words with a failing pair are
merged exactly. The vocabulary file is a parameter: a tokenizer JSON with NFC, white space and
lower-case normalisation, a pattern split, byte-level symbols and a word-end suffix.

A batch's runs of non-space are encoded once each: Arrow splits the texts and numbers the distinct runs, and the
ids and names of all places come from them by taking.

Defined results: a null or empty text has no tokens and decodes to the empty string; other columns of
the input are left out, so names can't clash; repeated rows give repeated results; no documents give no rows.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import pieces, texts

#: Bytes of a task's cache of runs before it starts anew, and what an entry takes beside its text and ids; results don't depend on it.
CACHE_BYTES, ENTRY_BYTES = 80_000_000, 170
NEVER = (1 << 60, -1)
#: Stands for the word end while pieces are matched; it is no byte-level symbol.
END = "\0"
#: White space, and the letters and numbers that the public library's Unicode tables (16.0 for its patterns, 17.0 for
#: lower case) have beyond Python's (15.1).
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LATER_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
LATER_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
#: Marks that Python's tables order or compose, and the library's (9.0 for NFC) take for characters that stand alone.
LATER_MARKS = [
    (0x7FD, 0x7FD), (0x898, 0x89F), (0x8CA, 0x8D3), (0x9FE, 0x9FE), (0xC3C, 0xC3C), (0xD3B, 0xD3C), (0xEBA, 0xEBA), (0x1715, 0x1715),
    (0x1ABF, 0x1ACE), (0x1DF6, 0x1DFA), (0xA82C, 0xA82C), (0x10D24, 0x10D27), (0x10EAB, 0x10EAC), (0x10EFD, 0x10EFF), (0x10F46, 0x10F50),
    (0x10F82, 0x10F85), (0x11070, 0x11070), (0x1133B, 0x1133B), (0x1145E, 0x1145E), (0x11839, 0x1183A), (0x11930, 0x11930), (0x1193D, 0x1193E),
    (0x11943, 0x11943), (0x119E0, 0x119E0), (0x11A34, 0x11A34), (0x11A47, 0x11A47), (0x11A99, 0x11A99), (0x11D42, 0x11D42), (0x11D44, 0x11D45),
    (0x11D97, 0x11D97), (0x11F41, 0x11F42), (0x16FF0, 0x16FF1), (0x1E08F, 0x1E08F), (0x1E130, 0x1E136), (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF),
    (0x1E4EC, 0x1E4EF),
]
#: First and last capital, and how far away its small letter is.
LATER_CAPITALS = [
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1),
    (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 32), (0x16EA0, 0x16EB8, 27),
]


def byte_symbols() -> list[str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others for U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(0x100 + extra)
            extra += 1
    return out


@functools.cache
def character_classes() -> tuple[str, str]:
    """The letters and the numbers of the library's patterns, as ranges of a character class."""
    kinds = {"L": list(LATER_LETTERS), "N": list(LATER_NUMBERS)}
    first, last = 0, "C"
    for c in range(sys.maxunicode + 2):
        kind = unicodedata.category(chr(c))[0] if c <= sys.maxunicode else "C"
        if kind != last:
            if last in kinds:
                kinds[last].append((first, c - 1))
            first, last = c, kind
    return ranges(kinds["L"]), ranges(kinds["N"])


def ranges(spans: list[tuple[int, int]]) -> str:
    """Spans of code points as the inside of a character class."""
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in sorted(spans))


def lowered(text: str) -> str:
    """NFC, then lower case letter by letter: str.lower() would look at the place of a capital sigma."""
    parts = AT_LATER_MARK.split(text)
    parts[::2] = [unicodedata.normalize("NFC", p) for p in parts[::2]]
    return "".join(parts).translate(LOWER).lower()


AT_LATER_MARK = re.compile(f"([{ranges(LATER_MARKS)}])")

LOWER = {ord("Σ"): "σ"} | {c: c + step for first, last, step in LATER_CAPITALS for c in range(first, last + 1)}


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        ids = self.ids
        #: (left id, right id) in one integer -> (rank, merged id)
        self.merges = {ids[a] << 20 | ids[b]: (rank, ids[a + b]) for rank, (a, b) in reversed([*enumerate(pairs)])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*ids.items(), *self.special.items()]}
        #: Latin-1 character of a byte -> its symbol
        self.symbols = dict(enumerate(byte_symbols()))
        self.keys = np.sort(np.fromiter(self.merges, np.int64, len(self.merges)))
        self.key_rank = np.array([self.merges[k][0] for k in self.keys.tolist()], np.int64)
        size = max(self.names) + 1
        #: rank of the merge that makes a piece (-1: a symbol), and the pieces it is made of
        self.rank, self.left, self.right = np.full(size, -1, np.int64), np.arange(size), np.arange(size)
        for key, (rank, made) in self.merges.items():
            self.rank[made], self.left[made], self.right[made] = rank, key >> 20, key & 0xFFFFF
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        letters, numbers = character_classes()
        for name, chars in ((r"\p{L}", letters), (r"\p{N}", numbers), (r"\s", WHITE_SPACE)):
            split = split.replace(f"[{name}]", f"[{chars}]").replace(name, chars)
        self.pattern = re.compile(split)
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.decimals = pa.array([f"{i} " for i in range(size)])
        self.spaced = pa.array([f"{self.names.get(i, '')} " for i in range(size)])
        #: Each start of a sound piece's name (word end as one character) -> the piece, or -1
        self.starts: dict[str, int] = {}
        for name, i in ids.items():
            if self.is_sound(i):
                form = name[: -len(self.end)] + END if self.end and name.endswith(self.end) else name
                for k in range(1, len(form)):
                    self.starts.setdefault(form[:k], -1)
                self.starts[form] = i
        self.cache: dict[str, bytes] = {}  # run of non-space or pre-token -> its ids
        self.held = CACHE_BYTES
        self.exact = self.guessed = 0

    def symbolic(self, word: str) -> str:
        """The word's bytes as symbols, one character each."""
        return word.encode("utf-8").decode("latin-1").translate(self.symbols)

    def letters(self, text: str) -> list[int]:
        """Ids of the initial symbols; the last one carries the word end. Unknown symbols are left out."""
        ids = self.ids
        return [i for c in [*text[:-1], text[-1:] + self.end] if (i := ids.get(c)) is not None]

    def merged(self, seq: list[int]) -> list[int]:
        """Exact merging: the lowest rank first, the leftmost of equals."""
        n = len(seq)
        if n <= 24:
            return self.merged_short(seq)
        seq, after, before, alive = list(seq), [*range(1, n), -1], [-1, *range(n - 1)], [True] * n
        merges, heap = self.merges, []
        for i in range(n - 1):
            if m := merges.get(seq[i] << 20 | seq[i + 1]):
                heap.append((m[0], i, seq[i], seq[i + 1], m[1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b, c = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or seq[i] != a or seq[j] != b:
                continue
            seq[i], alive[j], after[i] = c, False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
                if m := merges.get(c << 20 | seq[after[j]]):
                    heapq.heappush(heap, (m[0], i, c, seq[after[j]], m[1]))
            if (p := before[i]) >= 0 and (m := merges.get(seq[p] << 20 | c)):
                heapq.heappush(heap, (m[0], p, seq[p], c, m[1]))
        return [t for t, live in zip(seq, alive, strict=True) if live]

    def merged_short(self, seq: list[int]) -> list[int]:
        """The same by scanning for the lowest rank, which is quicker for few symbols."""
        merges = self.merges
        found = [merges.get(a << 20 | b, NEVER) for a, b in zip(seq, seq[1:], strict=False)]
        while found and (least := min(found)) is not NEVER:
            i = found.index(least)
            seq = [*seq[:i], least[1], *seq[i + 2 :]]
            del found[i]
            if i < len(found):
                found[i] = merges.get(seq[i] << 20 | seq[i + 1], NEVER)
            if i:
                found[i - 1] = merges.get(seq[i - 1] << 20 | seq[i], NEVER)
        return seq

    def parts(self, piece: int) -> list[int]:
        """The initial symbols of a piece."""
        name = self.names[piece]
        end = self.end if self.end and name.endswith(self.end) else ""
        chars = [*name[: len(name) - len(end)]]
        if end:
            chars[-1] += end
        return [self.ids[c] for c in chars]

    def is_sound(self, piece: int) -> bool:
        """Does the piece encode to itself? Its own last merge must not be forestalled, nor its halves."""
        return self.merged(self.parts(piece)) == [piece]

    def guess(self, text: str) -> list[int]:
        """Greedy longest match over sound pieces; empty if a symbol is unknown."""
        starts, out, i, j = self.starts, [], 0, 1
        text += END if self.end else ""
        size, best, cut = len(text), -1, 0
        while i < size:
            piece = starts.get(text[i:j])
            if piece is not None:
                if piece >= 0:
                    best, cut = piece, j
                j += 1
                if j <= size:
                    continue
            if best < 0:
                return []
            out.append(best)
            i, j, best = cut, cut + 1, -1
        return out

    def pairs_fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of each adjacent pair, whether merging leaves its boundary alone: all pairs at once.

        The pieces' last merges are undone from the latest backwards. A merge across the boundary that
        ranks before the merge undone last would have come first, so the pair can't stand.
        """
        a, b = a.copy(), b.copy()
        fits, live = np.ones(len(a), bool), np.arange(len(a))
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(live):
            x, y = a[live], b[live]
            key = x << 20 | y
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            broken = (self.keys[at] == key) & (self.key_rank[at] < limit[live])
            fits[live[broken]] = False
            undo_left = self.rank[x] > self.rank[y]
            limit[live] = np.where(undo_left, self.rank[x], self.rank[y] + 1)
            a[live] = np.where(undo_left, self.right[x], x)
            b[live] = np.where(undo_left, y, self.left[y])
            live = live[~broken & (np.maximum(self.rank[x], self.rank[y]) >= 0)]
        return fits

    def learn(self, words: list[str]) -> None:
        """Encode pre-tokens that are not known yet, all their pairs checked together."""
        forms = [self.symbolic(w) for w in words]
        guesses, flat, sizes = [], [], []
        for form in forms:
            g = self.guess(form)
            guesses.append(g)
            flat += g
            sizes.append(len(g))
        bad = np.array(sizes, np.int64) == 0
        owner = np.repeat(np.arange(len(words)), sizes)
        line = np.asarray(flat, np.int64)
        if len(line) > 1:
            inside = owner[1:] == owner[:-1]
            fits = self.pairs_fit(line[:-1][inside], line[1:][inside])
            bad[owner[1:][inside][~fits]] = True
        for word, form, g, failed in zip(words, forms, guesses, bad.tolist(), strict=True):
            if failed:
                g = self.merged(self.letters(form))
            self.keep(word, np.array(g, np.int32).tobytes())
        self.exact += int(bad.sum())
        self.guessed += int((~bad).sum())

    def keep(self, run: str, ids: bytes) -> None:
        self.cache[run] = ids
        self.held += len(run) + len(ids) + ENTRY_BYTES

    def pretokens(self, run: str) -> list[str]:
        """The run's pre-tokens; special tokens stand alone. Each pre-token is its own only one."""
        if self.at_special and "<|" in run and len(cut := self.at_special.split(run)) > 1:
            return [w for p in cut for w in ([p] if p in self.special else self.pretokens(p))]
        if run.isascii():
            run = run.lower()
            if run.isalpha():
                return [run]
            if run[:-1].isalpha() and not run[-1].isalnum():
                return [run[:-1], run[-1]]
        else:
            run = lowered(run)
        return self.pattern.findall(run)

    def forget(self) -> None:
        """Empty the cache: a worker that goes on to other tasks doesn't keep it."""
        self.cache, self.held = {t: np.int32(i).tobytes() for t, i in self.special.items()}, 0

    def known(self, runs: list[str]) -> list[bytes]:
        """The ids of each run."""
        if self.held >= CACHE_BYTES:
            self.forget()
        cache = self.cache
        split = [(r, self.pretokens(r)) for r in runs if r not in cache]
        self.learn([*{w for _, ws in split for w in ws if w not in cache}])
        for r, ws in split:
            if r not in cache:
                self.keep(r, b"".join([cache[w] for w in ws]))
        return [cache[r] for r in runs]

    def encoded_all(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after the other, and where each text's begin and end."""
        lists = pc.ascii_split_whitespace(column)
        coded = lists.flatten().dictionary_encode()
        each = self.known(coded.dictionary.to_pylist())
        n = np.array([len(x) // 4 for x in each], np.int64)
        flat = np.frombuffer(b"".join(each), np.int32)
        place = coded.indices.to_numpy()
        begin, many = (np.cumsum(n) - n)[place], n[place]
        upto = np.concatenate([[0], np.cumsum(many)])
        ids = flat[np.repeat(begin - upto[:-1], many) + np.arange(upto[-1])]
        runs = lists.offsets.to_numpy()
        return ids, upto[runs - runs[0]]

    def encoded(self, text: str) -> list[int]:
        return self.encoded_all(pa.array([text], pa.string()))[0].tolist()

    def decoded(self, ids: list[int]) -> str:
        """The pieces' names joined by a space, as the library has it where a file names no decoder; unknown ids are left out."""
        return " ".join(self.names[i] for i in ids if i in self.names)


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, once for each Python process."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, vocab: str | None = None, outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """doc_id, n_tokens and the wanted outputs: ids (array of int), decoded (text), digests (their SHA-256, as hexadecimal text).

    vocab is a vocabulary name of the installed tokenizer files, or a path that every executor has.
    """
    kinds = {"ids": [("ids", "array<int>")], "decoded": [("decoded", "string")], "digests": [("ids_sha256", "string"), ("decoded_sha256", "string")]}
    schema = ", ".join(["doc_id long", "n_tokens long", *(f"{n} {t}" for o in outputs for n, t in kinds[o])])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(vocab if vocab and "/" in vocab else vocabulary(vocab or "word_bpe_49k.json"))
        for whole in batches:
            _, offsets = texts(whole.column(1))
            for lo, hi in pieces(offsets):
                yield encoded_batch(tool, whole.slice(lo, hi - lo), outputs)
        tool.forget()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(work, schema)


def joined(names: pa.Array, ids: np.ndarray, at: np.ndarray) -> Iterator[memoryview]:
    """Each text's names, which end in a space each, without the last space."""
    _, offsets, data = names.take(pa.array(ids)).buffers()
    place = np.frombuffer(offsets, np.int32, len(ids) + 1)[at].tolist() if len(ids) else [0] * len(at)
    view = memoryview(data) if data is not None else memoryview(b"")
    for a, b in zip(place, place[1:], strict=False):
        yield view[a : max(a, b - 1)]


def encoded_batch(tool: Codec, batch: pa.RecordBatch, outputs: tuple[str, ...]) -> pa.RecordBatch:
    ids, at = tool.encoded_all(pc.fill_null(batch.column(1), ""))
    cols: dict[str, pa.Array] = {"doc_id": batch.column(0), "n_tokens": pa.array(np.diff(at), pa.int64())}
    for output in outputs:
        if output == "ids":
            cols["ids"] = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))
        elif output == "decoded":
            cols["decoded"] = pa.array([str(x, "utf-8") for x in joined(tool.spaced, ids, at)], pa.string())
        else:
            for name, words in (("ids_sha256", tool.decimals), ("decoded_sha256", tool.spaced)):
                cols[name] = pa.array([hashlib.sha256(x).hexdigest() for x in joined(words, ids, at)], pa.string())
    return pa.RecordBatch.from_pydict(cols)
