"""BPE encoding and decoding with chunks that many documents share encoded once.

A rolling hash over the bytes of a text cuts it into chunks wherever the hash of the last bytes has some zero
bits, so equal passages give equal chunks wherever they stand. Chunks that occur more than once
are found by their 128-bit names alone. One occurrence of each, its owner, encodes it; the ids go to all
texts that hold it. A text's other chunks are encoded where the text is.

A cut can lie within a word, so each join of two chunks is repaired: the words around it are
encoded again as they stand in the text. The window grows until it agrees with both chunks: each chunk's ids
end (begin) with those of its side of the window, and the window's outermost words have the ids that their
chunk gave them. The vocabulary drops white space and no token spans it, so a text may be cut at a blank.

Texts travel once, compressed, to where their rows meet; the two joins (owners, shared ids) read the same
shuffle. Equal texts are encoded once. Words go through the tokenizer's own library, beside a bounded table
of the last ones; without a decoder in the vocabulary file, a decoded text is its tokens joined by blanks.

Defined cases: a null text is empty and has no ids; repeated rows have equal results; an empty table gives an empty result; a text of any
length is one row, its chunks at most ``LARGEST`` bytes each (a single word of many megabytes goes to the library as a whole);
the vocabulary's added tokens are recognised in texts, as the library does. Only key and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.shared import text_of, written

VOCABULARY = "word_bpe_49k.json"
#: Bytes of a chunk: at least, at most, and one in how many places is a cut.
SMALLEST, LARGEST, SPACING = 256, 8192, 1024
#: Bytes that the rolling hash sees, a power of two.
SEEN = 32
#: Bytes of a text that are hashed at once.
STRETCH = 1 << 20
#: Pieces of text kept with their ids in a worker, and their longest.
PIECES_KEPT, LONGEST_KEPT = 1 << 19, 64
_ID = np.dtype("<u2")
WORD_END = b"</w>"
#: Letters up to U+017F and what they are not, for which normalisation is lower case alone; one capital grows by it.
LETTERS, DIGITS, BLANKS = "a-zªµºß-öø-ſ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
PLAIN = re.compile("[\0-\u012f\u0131-\u017f]*")
PLAIN_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{BLANKS}{LETTERS}{DIGITS}]+")


def _byte_values() -> np.ndarray:
    """One number for each byte, by a multiplicative rule."""
    mixed = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(29))) >> np.uint64(16)).astype(np.uint32)


_VALUES, _FACTOR = _byte_values(), 0x01000193


def _marks(data: np.ndarray) -> np.ndarray:
    """Places before which the hash of the last bytes asks for a cut."""
    found = []
    for begin in range(0, len(data), STRETCH):
        first = max(0, begin - SEEN + 1)
        value, width, factor = _VALUES[data[first : begin + STRETCH]], 1, _FACTOR
        while width < SEEN:
            value[width:] += value[:-width].copy() * np.uint32(factor)
            width, factor = width * 2, factor * factor & 0xFFFFFFFF
        at = np.flatnonzero((value >> np.uint32(8)) % np.uint32(SPACING) == 0) + first + 1
        found.append(at[at > begin])
    at = np.concatenate(found)
    at = at[at < len(data)]
    return at[(data[at] & 0xC0) != 0x80]


def chunks(text: bytes) -> list[tuple[int, int]]:
    """Begin and end of each chunk; a text has at least one, never cut within a character."""
    bounds, begin = [0], 0
    if len(text) > SMALLEST:
        data = np.frombuffer(text, np.uint8)
        marks = _marks(data)
        while len(text) - begin > SMALLEST:
            at = np.searchsorted(marks, begin + SMALLEST)
            end = min(int(marks[at]) if at < len(marks) else len(text), begin + LARGEST)
            while end < len(text) and data[end] & 0xC0 == 0x80:
                end -= 1
            if end >= len(text):
                break
            bounds.append(end)
            begin = end
    return list(zip(bounds, [*bounds[1:], len(text)]))


class WordBpe:
    """The tokenizer, made once in each Python worker. Ids are two bytes each.

    A text is taken apart into pieces that no token spans, and the ids of the last pieces are kept. Where all
    characters are plain, pieces are the words of the vocabulary's own pattern; in other texts, or
    where an added token may stand, they are what lies between the blanks of ASCII.
    """

    _made: dict[str, "WordBpe"] = {}

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        size = self._library.get_vocab_size(with_added_tokens=True)
        if size > np.iinfo(_ID).max + 1 or self._library.decoder is not None:
            raise ValueError("a vocabulary of at most 65,536 tokens without a decoder is wanted")
        self.tokens = [(self._library.id_to_token(i) or "").encode() for i in range(size)]
        self.decimals = [b"%d" % i for i in range(size)]
        self._ends = np.array([token.endswith(WORD_END) for token in self.tokens])
        self._words: dict[str, bytes] = {}
        self._others: dict[str, bytes] = {}

    @classmethod
    def at(cls, path: str) -> "WordBpe":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self._library.encode(text, add_special_tokens=False).ids, _ID)

    def _words_together(self, words: list[str]) -> dict[str, bytes]:
        """Words encoded as one text; each ends with the first token that ends a word."""
        ids = self._whole(" ".join(words))
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != len(words):
            return self._one_by_one(words)
        return {word: ids[begin:end].tobytes() for word, begin, end in zip(words, [0, *ends], ends)}

    def _one_by_one(self, pieces: list[str]) -> dict[str, bytes]:
        return {piece: self._whole(piece).tobytes() for piece in pieces}

    def encode(self, text: bytes) -> bytes:
        value = text.decode("utf-8", "replace")
        if PLAIN.fullmatch(value) and "<|" not in value:
            pieces, kept, learn = PLAIN_WORD.findall(value.lower()), self._words, self._words_together
        else:
            pieces, kept, learn = [piece.decode("utf-8", "replace") for piece in text.split()], self._others, self._one_by_one
        found = [kept.get(piece) for piece in pieces]
        if None in found:
            new = learn(list(dict.fromkeys(piece for piece, ids in zip(pieces, found) if ids is None)))
            found = [new[piece] if ids is None else ids for piece, ids in zip(pieces, found)]
            if len(kept) + len(new) > PIECES_KEPT:
                kept.clear()
            kept.update((piece, ids) for piece, ids in new.items() if len(piece) <= LONGEST_KEPT)
        return b"".join(found)

    def decode(self, ids: np.ndarray) -> bytes:
        return b" ".join(map(self.tokens.__getitem__, ids.tolist()))


def _back(text: bytes, begin: int, end: int, words: int) -> int:
    for _ in range(words):
        end = max(text.rfind(b" ", begin, end), text.rfind(b"\n", begin, end), begin)
    return end


def _ahead(text: bytes, begin: int, end: int, words: int) -> int:
    at = begin - 1
    for _ in range(words):
        found = [x for x in (text.find(b" ", at + 1, end), text.find(b"\n", at + 1, end)) if x >= 0]
        if not found:
            return end
        at = min(found)
    return at


def joined(bpe: WordBpe, text: bytes, places: list[tuple[int, int]], ids: list[bytes]) -> bytes:
    """Ids of a text from those of its chunks.

    ``settled`` and ``own`` are the ids of the text up to the end of the last chunk; ``own`` covers
    what lies after ``begin``, a place where the text may be cut. It is None where no chunk since then had
    blanks enough: that stretch is encoded once, when its end is found, however many chunks it spans.
    """
    settled, own, begin = [], ids[0], 0
    for (at, end), after in zip(places[1:], ids[1:]):
        if text[at - 1 : at].isspace() or text[at : at + 1].isspace():
            settled.append(bpe.encode(text[begin:at]) if own is None else own)
            own, begin = after, at
            continue
        reach = 2
        while True:
            left = begin if own is None else _back(text, begin, at, reach)
            right = _ahead(text, at, end, reach)
            tail = bpe.encode(text[left:at]) if left > begin else b""
            first = bpe.encode(text[left : _ahead(text, left + 1, at, 1)]) if left > begin else b""
            same_left = left == begin or (own.endswith(tail) and tail.startswith(first))
            if right == end:
                if left > begin and same_left:
                    settled.append(own[: len(own) - len(tail)])
                    begin = left
                own = None
                break
            head, window = bpe.encode(text[at:right]), bpe.encode(text[left:right])
            last = bpe.encode(text[_back(text, at, right, 1) : right])
            if same_left and window.startswith(first) and after.startswith(head) and head.endswith(last) and window.endswith(last):
                settled += [own[: len(own) - len(tail)] if left > begin else b"", window]
                own, begin = after[len(head) :], right
                break
            reach *= 2
    settled.append(bpe.encode(text[begin:]) if own is None else own)
    return b"".join(settled)


def vocabulary_path(file: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(file)


TEXT = ["__t1", "__t2"]
CHUNK = ["__c1", "__c2"]


def _identity(text: str) -> list[Column]:
    value = text_of(text)
    return [F.xxhash64(value).alias("__t1"), F.xxhash64(F.lit(1), value).alias("__t2")]


def _occurrences(docs: DataFrame, text: str) -> DataFrame:
    """Each distinct text's chunks by name."""

    def named(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, numbers, names = [], [], []
            for row, value in enumerate(batch.column(2)):
                value = value.as_py()
                for number, (begin, end) in enumerate(chunks(value)):
                    rows.append(row), numbers.append(number), names.append(xxhash.xxh3_128_digest(value[begin:end]))
            at, name = pa.array(rows, pa.int64()), np.frombuffer(b"".join(names), "<i8").reshape(-1, 2)
            columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(numbers, pa.int32()),
                       pa.array(name[:, 0]), pa.array(name[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, [*TEXT, "number", *CHUNK])

    given = docs.select(*_identity(text), text_of(text).cast("binary").alias("text"))
    found = given.mapInArrow(named, "__t1 long, __t2 long, number int, __c1 long, __c2 long")
    return found.groupBy(*TEXT, "number").agg(F.first("__c1").alias("__c1"), F.first("__c2").alias("__c2"))


def _packed_texts(docs: DataFrame, text: str) -> DataFrame:
    """Distinct texts, compressed."""

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            values = pa.array([packer.compress(value.as_py()) for value in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), values], [*TEXT, "packed"])

    given = docs.select(*_identity(text), text_of(text).cast("binary").alias("text"))
    return given.mapInArrow(packed, "__t1 long, __t2 long, packed binary").groupBy(*TEXT).agg(F.first("packed").alias("packed"))


def _encoded_owned(texts: DataFrame, owned: DataFrame, path: str) -> DataFrame:
    """``chunk name, ids`` from the texts that own chunks."""

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, unpacker = WordBpe.at(path), zstandard.ZstdDecompressor()
        for batch in batches:
            names, ids = [], []
            for value, own in zip(batch.column(0), batch.column(1)):
                if not value.is_valid:
                    continue
                value = unpacker.decompress(value.as_py())
                places = chunks(value)
                for each in own.as_py():
                    begin, end = places[each["number"]]
                    names.append((each["__c1"], each["__c2"])), ids.append(bpe.encode(value[begin:end]))
            name = np.array(names, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(name[:, 0]), pa.array(name[:, 1]), pa.array(ids, pa.binary())], [*CHUNK, "ids"])

    # An inner join would read other texts than the join for all of them does, and so shuffle them once more.
    held = texts.join(owned, TEXT, "left").select(F.when(F.col("owned").isNotNull(), F.col("packed")).alias("packed"), "owned")
    return held.mapInArrow(encoded, "__c1 long, __c2 long, ids binary")


def _encoded_texts(texts: DataFrame, shared: DataFrame, path: str, keep_ids: bool) -> DataFrame:
    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, unpacker = WordBpe.at(path), zstandard.ZstdDecompressor()
        for batch in batches:
            made = []
            for value, given in zip(batch.column(2), batch.column(3)):
                value = unpacker.decompress(value.as_py())
                known = {each["number"]: each["ids"] for each in given.as_py() or ()}
                places = chunks(value)
                parts = [known[i] if i in known else bpe.encode(value[begin:end]) for i, (begin, end) in enumerate(places)]
                ids = np.frombuffer(joined(bpe, value, places, parts), _ID)
                decimal = b" ".join(map(bpe.decimals.__getitem__, ids.tolist()))
                made.append((len(ids), hashlib.sha256(decimal).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest(),
                             *([ids.astype("i4")] if keep_ids else [])))
            columns = list(zip(*made)) or [[], [], [], *([[]] if keep_ids else [])]
            types = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names)

    names = [*TEXT, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if keep_ids else [])]
    schema = "__t1 long, __t2 long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if keep_ids else "")
    return texts.join(shared, TEXT, "left").select(*TEXT, "packed", "shared").mapInArrow(encoded, schema)


def encode_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, keep_ids: bool = False,
) -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256[, ids]``: a row for each row of ``docs``."""
    path = vocabulary or vocabulary_path()
    occurrences = written(_occurrences(docs, text), "chunks")
    places = F.struct(*TEXT, "number")
    many = occurrences.groupBy(*CHUNK).agg(F.count(F.lit(1)).alias("n"), F.min(places).alias("at")).filter(F.col("n") > 1)
    owned = many.select("at.*", *CHUNK).groupBy(*TEXT).agg(F.collect_list(F.struct("number", *CHUNK)).alias("owned"))

    texts = _packed_texts(docs, text)
    ids = _encoded_owned(texts, owned, path)
    shared = occurrences.join(ids, CHUNK).groupBy(*TEXT).agg(F.collect_list(F.struct("number", "ids")).alias("shared"))
    results = _encoded_texts(texts, shared, path, keep_ids)
    rows = docs.select(F.col(key).alias("__key"), *_identity(text)).join(results, TEXT)
    return rows.drop(*TEXT).withColumnRenamed("__key", key)
