"""Byte-level BPE encoding and decoding with merge rounds over flat numpy arrays.

Texts are cut into words by the tokenizer's pattern. Words that a worker has
not met yet are encoded together: the symbols of all of them lie in one flat
array, and in each round every word merges its lowest-ranked adjacent pair,
found by binary search over the sorted pair keys. Encoded words are remembered
as bytes, so a text's ids are a concatenation.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from framequarry.llm._shared import slices, table

#: Words after which a worker forgets those it hasn't met for as many, and the longest word that is remembered.
CACHE_WORDS = 80_000
CACHE_CHARS = 64

# White space as the Unicode property has it, in place of \s, which Python's modules read differently.
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def _pattern(letters: str, numbers: str) -> str:
    return rf"'(?:[stmd]|re|ve|ll)| ?[{letters}]+| ?[{numbers}]+| ?[^{_WS}{letters}{numbers}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"


#: For texts without characters from U+0250 on, whose letters and numbers can be listed, and for all others.
_NARROW = re.compile(_pattern("A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f", "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"))
_WIDE = regex.compile(_pattern(r"\p{L}", r"\p{N}"))
_NOT_NARROW = re.compile("[^\\x00-\\u024f]")


def split_words(text: str) -> list[str]:
    return (_WIDE if _NOT_NARROW.search(text) else _NARROW).findall(text)


def _byte_chars() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself where printable, else the next free character from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def _check(spec: dict) -> None:
    """ValueError where a tokenizer file asks for something that isn't done here: it would give other ids."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    wrong = []
    if spec.get("normalizer") is not None:
        wrong.append("normalizer")
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        wrong.append("pre_tokenizer")
    if (spec.get("decoder") or {}).get("type") != "ByteLevel":
        wrong.append("decoder")
    wrong += [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    if model.get("type", "BPE") != "BPE" or any(x.get(k) for x in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
        wrong.append("model or added tokens")
    if wrong:
        raise ValueError(f"the tokenizer file's {', '.join(wrong)} can't be followed")


class Vocabulary:
    """What encoding and decoding need of a tokenizer file; small enough to send to every worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        _check(spec)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        chars = _byte_chars()
        as_byte = {c: b for b, c in enumerate(chars)}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, k in vocab.items():
            self.tokens[k] = bytes(as_byte[c] for c in token)
        for token, k in self.special.items():
            self.tokens[k] = token.encode()
        self.byte_ids = np.array([vocab[c] for c in chars], np.int64)
        pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.results = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]


class Codec:
    """Encodes and decodes with a vocabulary; remembers words."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.cache: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.special = re.compile("|".join(map(re.escape, vocabulary.special))) if vocabulary.special else None

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word (little-endian, 32 bits each), by rounds over all words that still have a pair to merge."""
        v, none = self.v, np.int64(1) << 40
        flat = v.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])

        def lookup(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Place among the sorted pairs, and rank, of the pairs that start at ``at``."""
            after = np.minimum(at + 1, len(flat) - 1)
            key = flat[at] << 32 | flat[after]
            found = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
            good = (v.keys[found] == key) & (owner[at] == owner[after]) & (after > at)
            return found, np.where(good, v.ranks[found], none)

        place, rank = lookup(np.arange(len(flat)))
        done_symbols, done_owners = [], []
        while len(flat):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(starts, len(flat)))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            keep = lowest < none
            if not keep.all():
                done_symbols.append(flat[~keep])
                done_owners.append(owner[~keep])
            at = np.flatnonzero((rank == lowest) & keep)
            if not len(at):
                break
            # where a pair overlaps itself, as in "aaa", every other one counts from the left
            first = np.append(True, np.diff(at) != 1)
            run = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
            at = at[run % 2 == 0]
            flat[at] = v.results[place[at]]
            keep[at + 1] = False
            moved = np.cumsum(keep)[at] - 1
            flat, owner, place, rank = flat[keep], owner[keep], place[keep], rank[keep]
            changed = np.concatenate([moved, moved[moved > 0] - 1])
            place[changed], rank[changed] = lookup(changed)
        symbols, owners = np.concatenate(done_symbols), np.concatenate(done_owners)
        order = np.argsort(owners, kind="stable")
        ends = (4 * np.cumsum(np.bincount(owners, minlength=len(words)))).tolist()
        data = symbols[order].astype("<u4").tobytes()
        return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Make every word known; returns those too long to be remembered."""
        extra = {}
        if len(self.cache) > CACHE_WORDS:  # what was met since the last turn stays for one more
            self.old, self.cache = self.cache, {}
        new = []
        for w in words.difference(self.cache):
            known = self.old.get(w)
            if known is None:
                new.append(w)
            else:
                self.cache[w] = known
        # blocks of a bounded number of bytes, so that the rounds' arrays stay small
        block, size = [], 0
        for k, w in enumerate(new):
            block.append(w)
            size += len(w)
            if size >= 1 << 17 or k == len(new) - 1:
                for x, ids in zip(block, self.merge_words([x.encode("utf-8", "surrogatepass") for x in block]), strict=True):
                    (self.cache if len(x) <= CACHE_CHARS else extra)[x] = ids
                block, size = [], 0
        return extra

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        cut: list[list] = []  # per text: lists of words, and bytes for special tokens between them
        for text in texts:
            parts, at = [], 0
            for m in self.special.finditer(text) if self.special else ():
                parts += [split_words(text[at : m.start()]), np.array([self.v.special[m.group()]], "<u4").tobytes()]
                at = m.end()
            parts.append(split_words(text[at:]))
            cut.append(parts)
        words = set().union(*(p for parts in cut for p in parts if isinstance(p, list)))
        extra = self._learn(words)
        get = self.cache.__getitem__ if not extra else lambda w: self.cache.get(w) or extra[w]
        return [b"".join(p if isinstance(p, bytes) else b"".join(map(get, p)) for p in parts) for parts in cut]

    def decode(self, ids: bytes) -> str:
        tokens = self.v.tokens
        return b"".join([tokens[k] for k in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def _codec(broadcast, key: str) -> Codec:
    """The worker's codec for a vocabulary, kept between tasks."""
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(broadcast.value)
    return _CODECS[key]


def _sent(spark: SparkSession, path: str):
    """Broadcast a tokenizer's vocabulary: some MB, however large the corpus; workers needn't see the file."""
    vocabulary = Vocabulary(path)
    key = hashlib.sha256(vocabulary.keys.tobytes() + vocabulary.ranks.tobytes() + json.dumps(vocabulary.special).encode()).hexdigest()
    return spark.sparkContext.broadcast(vocabulary), key


_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def token_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each whole text, decode its ids, and return one row of counts and digests per row.

    A null text counts as empty; null ids and repeated rows are kept as they
    are; an empty table gives an empty result; other columns are not read.
    """
    broadcast, key = _sent(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(broadcast, key)
        for batch in slices(batches):
            encoded = codec.encode_batch([t or "" for t in batch.column(1).to_pylist()])
            decoded = [hashlib.sha256(codec.decode(x).encode("utf-8", "surrogatepass")).hexdigest() for x in encoded]
            columns = [batch.column(0), pa.array([len(x) // 4 for x in encoded], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in encoded], pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"cast(`{text_col}` as string) text").mapInArrow(run, _SCHEMA)


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "token_ids") -> DataFrame:
    """``docs`` with a column of token ids (array of int) in place of any column of that name; a null text has none."""
    broadcast, key = _sent(docs.sparkSession, path)
    kept = [c for c in docs.columns if c != out_col]
    source = docs.select(*(f"`{c}`" for c in kept))
    at = kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(broadcast, key)
        for batch in slices(batches):
            encoded = codec.encode_batch([t or "" for t in batch.column(at).to_pylist()])
            ends = np.cumsum([0, *(len(x) // 4 for x in encoded)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(encoded), "<i4"), pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*kept, out_col])

    from pyspark.sql.types import ArrayType, IntegerType, StructType

    return source.mapInArrow(run, StructType([*source.schema.fields]).add(out_col, ArrayType(IntegerType())))


def decode_ids(docs: DataFrame, path: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the decoded text of a column of token ids; null ids decode to null."""
    broadcast, key = _sent(docs.sparkSession, path)
    kept = [c for c in docs.columns if c != out_col]
    source = docs.select(*(f"`{c}`" for c in kept))
    at = kept.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(broadcast, key)
        for batch in slices(batches):
            texts = [None if x is None else codec.decode(np.array(x, "<u4").tobytes()) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, out_col])

    from pyspark.sql.types import StringType, StructType

    return source.mapInArrow(run, StructType([*source.schema.fields]).add(out_col, StringType()))


def default_path() -> str:
    """The public byte-level vocabulary that the query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"), default_path())
