"""BPE encoding and decoding by depth-first traversal of a trie of distinct words.

Two facts make it work. A token sequence is the encoding of its text exactly if each pair of
neighbours is the encoding of the pair's own text. So a prefix has one possible last token: the
one suffix token that fits the last token of what stands before it. The state of a trie node is
therefore one token, and every word below the node shares it.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from thermocline.llm.rows import add_columns, col_of, map_arrow, own_memory, slices

#: Chunks of text between white space whose encodings a worker remembers; past it, it keeps the third that it needed most.
REMEMBERED = 250_000
NO_MERGE = (1 << 40, 0)
END = "\u0100"


def byte_symbols() -> list[str]:
    """The printable character for each byte in byte-level vocabularies: itself, if printable Latin-1, else the next code point from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """A tokenizer file (JSON text) of a byte-level BPE with an end-of-word suffix."""

    def __init__(self, file: str):
        spec = json.loads(file)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: s for s, i in ids.items()} | {i: s for s, i in self.special.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        symbols = byte_symbols()
        to_byte = {s: b for b, s in enumerate(symbols)}
        self.inner: dict[bytes, int] = {}  # tokens inside a word
        self.last: dict[bytes, int] = {}  # tokens that end a word
        self.size = [0] * len(self.names)
        self.single = [ids[s] for s in symbols]
        self.single_last = [ids[s + self.end] for s in symbols]
        for name, i in ids.items():
            ends = bool(self.end) and name.endswith(self.end)
            body = name[: len(name) - len(self.end)] if ends else name
            if body and all(c in to_byte for c in body):
                raw = bytes(to_byte[c] for c in body)
                (self.last if ends else self.inner)[raw] = i
                self.size[i] = len(raw)
        self.text = {i: raw for table in (self.inner, self.last) for raw, i in table.items()}
        self.ends = set(self.last.values())
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(ids[a], ids[b]): (r, ids[a + b]) for r, (a, b) in enumerate(merges)}
        self.follows: dict[int, dict[int, bool]] = {i: {} for i in self.text}
        # every token that ends at a place of a word, longest first; END stands for the end of a word
        self.found_at = ahocorasick.Automaton()
        for table, tail in ((self.inner, ""), (self.last, END)):
            for raw, i in table.items():
                self.found_at.add_word(raw.decode("latin-1") + tail, (i, len(raw) + len(tail), self.follows[i]))
        self.found_at.make_automaton()
        split = "|".join(regex.escape(s) for s in self.special)
        self.specials = regex.compile(f"({split})") if split else None
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        self.file = file

    def merged(self, raw: bytes, ends: bool) -> list[int]:
        """The encoding by merging, for the short texts of one or two tokens."""
        ids = [self.single[b] for b in raw]
        if ends:
            ids[-1] = self.single_last[raw[-1]]
        rank = self.rank
        while len(ids) > 1:
            merges = [rank.get(pair, NO_MERGE) for pair in zip(ids, ids[1:])]
            best = min(merges)
            if best is NO_MERGE:
                break
            k = merges.index(best)
            ids[k : k + 2] = [best[1]]
        return ids

    def fits(self, before: int, token: int) -> bool:
        """True if token may follow before (-1: if it may begin a word)."""
        head = b"" if before < 0 else self.text[before]
        return self.merged(head + self.text[token], token in self.ends) == ([token] if before < 0 else [before, token])

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Encodings of distinct words, in their order.

        Sorted, the words are the leaves of their trie in depth-first order: path holds the last
        token of each prefix of the current word, and the part a word shares with the one before
        it stays. A word's encoding is read off the path backwards.
        """
        raws = [w.encode().decode("latin-1") for w in words]
        encoded: list[list[int]] = [[]] * len(words)
        path, above = [-1], ""
        for k in sorted(range(len(raws)), key=raws.__getitem__):
            raw = raws[k]
            shared = 0
            for a, b in zip(above, raw):
                if a != b:
                    break
                shared += 1
            above = raw
            done = shared
            del path[shared + 1 :]
            for at, (token, size, follows) in self.found_at.iter(raw + END):
                if at < done:
                    continue
                before = path[at + 1 - size]
                fits = follows.get(before)
                if fits is None:
                    fits = follows[before] = self.fits(before, token)
                if fits:
                    path.append(token)
                    done += 1
            if done != len(raw) + 1:
                raise ValueError("the vocabulary lacks a byte of a word")
            sizes = self.size
            token = path.pop()
            ids, depth = [token], len(raw) - sizes[token]
            while depth:
                token = path[depth]
                ids.append(token)
                depth -= sizes[token]
            ids.reverse()
            encoded[k] = ids
        return encoded

    def pieces(self, chunk: str) -> list[str]:
        """Words of a chunk of text between white space, in order; special strings stand as themselves."""
        if self.specials is not None and "<|" in chunk:
            parts = self.specials.split(chunk)
            return list(chain.from_iterable([p] if k % 2 else self.plain(p) for k, p in enumerate(parts)))
        return self.plain(chunk)

    def plain(self, chunk: str) -> list[str]:
        if not chunk.isascii():
            if any(unicodedata.ucd_3_2_0.category(c) == "Cn" for c in chunk):
                # characters of later Unicode versions: as the tokenizers library classes them
                return self.library(chunk)
            # lower case goes by character, so a final sigma is no case of its own
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        return self.words.findall(chunk.lower())

    def library(self, chunk: str) -> list[str]:
        if not hasattr(self, "tokenizer"):
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_str(self.file)
            self.from_symbol = {s: b for b, s in enumerate(byte_symbols())}
        parts = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(chunk))
        return [bytes(self.from_symbol[c] for c in p).decode() for p, _ in parts]

    @staticmethod
    def chunks(text: str) -> list[str]:
        """A text cut at white space, of which these four separators are no part here."""
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return regex.findall(r"[\S\x1c-\x1f]+", text)
        return text.split()


class Encoder:
    """Encodings of slices of texts, with a bounded memory of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.values: list[np.ndarray] = [np.zeros(0, np.int32)]
        self.lengths: list[int] = []
        self.needed = np.zeros(0, np.int64)

    def shrink(self) -> None:
        """Forget all but the chunks needed most often of late."""
        n = REMEMBERED // 3
        keep = np.sort(np.argsort(self.needed, kind="stable")[-n:])
        names = list(self.index)
        values, lengths = np.concatenate(self.values), np.array(self.lengths, dtype=np.int64)
        begins = np.cumsum(lengths) - lengths
        places = np.repeat(begins[keep] - (np.cumsum(lengths[keep]) - lengths[keep]), lengths[keep]) + np.arange(lengths[keep].sum())
        self.index = {names[k]: number for number, k in enumerate(keep.tolist())}
        self.values, self.lengths, self.needed = [values[places]], lengths[keep].tolist(), self.needed[keep] // 2

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], np.ndarray]:
        """The numbers of all chunks on end, and where each text begins; values and lengths hold the encodings by number."""
        if len(self.index) > REMEMBERED:
            self.shrink()
        index = self.index
        words = [self.vocabulary.chunks(t) if t else [] for t in texts]
        new = list(set(chain.from_iterable(words)).difference(index))
        if new:
            special = self.vocabulary.special
            pieces = [self.vocabulary.pieces(c) for c in new]
            distinct = list(set(chain.from_iterable(pieces)).difference(special))
            ids = dict(zip(distinct, self.vocabulary.encode_words(distinct))) | {s: [i] for s, i in special.items()}
            encoded = [ids[p[0]] if len(p) == 1 else list(chain.from_iterable(map(ids.__getitem__, p))) for p in pieces]
            first = len(self.lengths)
            index.update(zip(new, range(first, first + len(new))))
            self.lengths.extend(map(len, encoded))
            self.values.append(np.fromiter(chain.from_iterable(encoded), np.int32))
        numbers = np.fromiter(chain.from_iterable(map(index.__getitem__, ws) for ws in words), np.int64, sum(map(len, words)))
        self.needed = np.bincount(numbers, minlength=len(self.lengths)) + np.pad(self.needed, (0, len(self.lengths) - len(self.needed)))
        return numbers, np.concatenate([[0], np.cumsum([len(ws) for ws in words], dtype=np.int64)])

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and where each text begins."""
        numbers, bounds = self.encode(texts)
        if len(self.values) > 1:
            self.values = [np.concatenate(self.values)]
        values = self.values[0]
        lengths = np.array(self.lengths, dtype=np.int64)
        begins = np.cumsum(lengths) - lengths
        counts = lengths[numbers]
        ends = np.concatenate([[0], np.cumsum(counts)])
        places = np.repeat(begins[numbers] - ends[:-1], counts) + np.arange(ends[-1])
        return values[places], ends[bounds]

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Number of ids of each text."""
        numbers, bounds = self.encode(texts)
        ends = np.concatenate([[0], np.cumsum(np.array(self.lengths, dtype=np.int64)[numbers])])
        return np.diff(ends[bounds])


_workers: dict[int, Encoder] = {}


def _encoder(file: str) -> Encoder:
    """One encoder a worker process and vocabulary."""
    own_memory(__name__, _workers.clear)
    key = hash(file)
    if key not in _workers:
        _workers[key] = Encoder(Vocabulary(file))
    return _workers[key]


def read_vocabulary(path: str) -> str:
    """Text of a tokenizer file on the driver's disk; it travels to the executors as a broadcast of a fixed few MB."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def decoded_texts(values: np.ndarray, ends: np.ndarray, names: list[str]) -> list[str]:
    """Texts of runs of ids: vocabulary strings joined by one space; an id outside the vocabulary gives an empty string."""
    known = len(names)
    words = [names[i] if 0 <= i < known else "" for i in values.tolist()]
    bounds = ends.tolist()
    return [" ".join(words[a:b]) for a, b in zip(bounds, bounds[1:])]


def encode(docs: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """docs with a column of token ids (array of int) added, or replaced if it is there; with decoded, also a column of what the ids decode to.

    A null or empty text, and one of white space alone, has the empty array. Every other row is
    encoded whole, equal rows alike. Other columns pass through, whatever their names. No shuffle.
    """
    file = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def make():
        encoder = _encoder(file.value)

        def compute(texts: pa.Array) -> list[pa.Array]:
            values, ends = encoder.ids(texts.to_pylist())
            out = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))]
            return out if decoded is None else [*out, pa.array(decoded_texts(values, ends, encoder.vocabulary.names), pa.string())]

        return compute

    added = {ids: T.ArrayType(T.IntegerType())} | ({} if decoded is None else {decoded: T.StringType()})
    return add_columns(docs, [text], added, make)


def encoded_lengths(docs: DataFrame, vocabulary_path: str, text: str = "text", length: str = "n_tokens") -> DataFrame:
    """One row a document: the number of ids encode() gives its text (null and empty texts: 0)."""
    file = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(file.value)
        for batch in batches:
            for part in slices(batch, 0):
                yield pa.RecordBatch.from_arrays([pa.array(encoder.counts(part.column(0).to_pylist()), pa.int64())], names=["n"])

    return map_arrow(docs.select(col_of(text).alias("text")), run, "n long").withColumnRenamed("n", length)


def decode(encoded: DataFrame, vocabulary_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """encoded with the text of its ids added: vocabulary strings joined by one space, special ones included.

    This is what the tokenizer file asks for, which names no decoder. A null or empty array gives
    the empty text; an id outside the vocabulary gives an empty string in its place.
    """
    names = encoded.sparkSession.sparkContext.broadcast(Vocabulary(read_vocabulary(vocabulary_path)).names)

    def make():
        table = names.value

        def compute(column: pa.Array) -> list[pa.Array]:
            sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            return [pa.array(decoded_texts(column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), table), pa.string())]

        return compute

    return add_columns(encoded, [ids], {decoded: T.StringType()}, make, texts=False)


def tokens(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns key, ids and decoded of every document, encoded and decoded in one pass."""
    return encode(docs.select(col_of(key), col_of(text)), vocabulary_path, text, decoded="decoded").select(col_of(key), "ids", "decoded")
