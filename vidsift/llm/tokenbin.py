"""Token ids in a fixed-width bit-packed file format.

A shard is one block of bytes, little-endian throughout:

    8s magic | u32 bits | u32 ids in a block | u64 documents | u64 ids | u64 blocks
    documents x (u8 has an id | i64 doc_id | u64 first id)  column by column, then
    (blocks + 1) x u64 offsets of the packed blocks | packed blocks

Each id takes the bits that the vocabulary needs, least significant first; every block starts on a byte, so any id
range is read by unpacking the blocks that hold it, all ids of a block in one numpy pass. Shards are the rows of a
Parquet table that Spark commits (part, shard, n_docs, n_tokens, data), in ascending document order, so executors
need no shared local folder and a lost task leaves no half-written file.
"""

from __future__ import annotations

import struct
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, partitions, release, running_sum, strings, sums, text_batches, words

MAGIC = b"VSTOKEN1"
HEAD = struct.Struct("<8sIIQQQ")
BLOCK = 4096
SHARD_IDS = 1_000_000
KEPT_WORDS = 1_000_000


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    flat = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(flat.reshape(-1), bitorder="little").tobytes()


def unpack_ids(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    raw = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[: n * bits].reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = raw
    return np.packbits(wide, axis=1, bitorder="little").reshape(-1).view("<u4").astype(np.uint32)


def pack_shard(doc_ids: list[int | None], firsts: np.ndarray, ids: np.ndarray, bits: int, block: int = BLOCK) -> bytes:
    """firsts: where each document's ids begin within ids."""
    packed = [pack_ids(ids[a : a + block], bits) for a in range(0, len(ids), block)]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in packed], dtype=np.int64)]) if packed else np.zeros(1)
    has = np.array([d is not None for d in doc_ids], np.uint8)
    named = np.array([0 if d is None else d for d in doc_ids], "<i8")
    return b"".join([HEAD.pack(MAGIC, bits, block, len(doc_ids), len(ids), len(packed)), has.tobytes(), named.tobytes(), firsts.astype("<u8").tobytes(), offsets.astype("<u8").tobytes(), *packed])


class Shard:
    """Reads one shard; ids() unpacks only the blocks that hold what is asked for."""

    def __init__(self, data: bytes):
        magic, self.bits, self.block, self.n_docs, self.n_ids, self.n_blocks = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = HEAD.size
        self.has = np.frombuffer(data, np.uint8, self.n_docs, at)
        self.doc_ids = np.frombuffer(data, "<i8", self.n_docs, at := at + self.n_docs)
        self.firsts = np.frombuffer(data, "<u8", self.n_docs, at := at + 8 * self.n_docs).astype(np.int64)
        self.offsets = np.frombuffer(data, "<u8", self.n_blocks + 1, at := at + 8 * self.n_docs).astype(np.int64)
        self.data, self.base = data, at + 8 * (self.n_blocks + 1)

    def ids(self, start: int, end: int) -> np.ndarray:
        if not 0 <= start <= end <= self.n_ids:
            raise IndexError(f"{start}:{end} of {self.n_ids}")
        if start == end:
            return np.zeros(0, np.uint32)
        a, b = start // self.block, -(-end // self.block)
        parts = [unpack_ids(self.data[self.base + self.offsets[i] : self.base + self.offsets[i + 1]], self.bits, min(self.block, self.n_ids - i * self.block)) for i in range(a, b)]
        return np.concatenate(parts)[start - a * self.block : end - a * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.firsts[i]), int(self.firsts[i + 1]) if i + 1 < self.n_docs else self.n_ids)


#: What a file must say for words to be cut into pieces beforehand, see ``pieces``.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
LETTER, DIGIT, MARK, OTHER = range(4)
KINDS = np.array([LETTER if chr(c).isalpha() else DIGIT if chr(c).isdigit() else MARK if 0x20 < c < 0x7F else OTHER for c in range(128)] + [OTHER] * 128, np.uint8)


def pieces(listed: pa.Array, special: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Each word's first piece number (and the end), each piece's code, the pieces by code, which are one pre-token.

    A word is cut between an ASCII or Latin-1 letter, an ASCII digit and an ASCII mark wherever SPLIT surely ends one
    match and begins another, which leaves the ids as they are; letters are lower-cased where no combining mark can
    follow. Words with a special string stay whole, as the file looks for those first.
    """
    offsets = np.frombuffer(listed.buffers()[1], np.int64, len(listed) + 1, 8 * listed.offset)
    data = np.frombuffer(listed.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].copy()
    offsets = offsets - offsets[0]
    kind = KINDS[data]
    lead = np.flatnonzero(data == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = LETTER
    for s in special:
        for i in np.flatnonzero(pc.match_substring(listed, s, ignore_case=True).to_numpy(zero_copy_only=False)).tolist():
            kind[offsets[i] : offsets[i + 1]] = OTHER
    after = np.append(kind[1:], LETTER)
    after[offsets[1:] - 1] = LETTER
    held = (data == ord("'")) & (after == LETTER)
    held[offsets[1:] - 1] = False
    cut = np.ones(len(data), bool)
    cut[1:] = ((kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)) & (kind[1:] != OTHER) & (kind[:-1] != OTHER) & ~held[:-1]
    cut[offsets[:-1]] = True
    lower = (kind == LETTER) & (after != OTHER)
    data[lower & (data >= ord("A")) & (data <= ord("Z"))] += 32
    tail = lead[lower[lead + 1]] + 1
    data[tail[data[tail] <= 0x9E]] += 32
    starts = np.flatnonzero(cut)
    each = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data)])
    coded = each.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    single = np.ones(len(coded.dictionary), bool)
    single[codes[np.searchsorted(starts, np.flatnonzero((kind == OTHER) | held), "right") - 1]] = False
    return np.searchsorted(starts, offsets), codes, coded.dictionary, single


def spread(values: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + lens[i]] for each i in turn."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(values)) < 2**31 else np.int64
    place = np.repeat((starts - (ends - lens)).astype(kind), lens)
    place += np.arange(total, dtype=kind)
    return values[place]


class WordEncoder:
    """Encodes texts with a tokenizers file whose pieces never cross ASCII white space.

    White space only separates words for such a file, so a text's ids are its words' ids in turn. Words are cut further
    where the file is known to cut them; the library encodes each different piece, and those seen before are looked up
    by a 128-bit hash in arrays of bounded size.
    """

    known: dict[str, "WordEncoder"] = {}

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [a["content"] for a in spec.get("added_tokens") or []]
        self.last = self.last_ids(spec)
        self.plain = self.last is not None
        self.forget()

    @staticmethod
    def last_ids(spec: dict) -> np.ndarray | None:
        """Which ids end a pre-token, None if the file is not known to cut words as ``pieces`` does.

        A pre-token's last id, and no other, ends in the suffix: so ids of pre-tokens encoded in a row come apart again.
        """
        from tokenizers.pre_tokenizers import ByteLevel

        model, end = spec["model"], "</w>"
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
        bare = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
        if spec.get("truncation") or spec.get("padding") or (spec.get("normalizer") or {}).get("normalizers") != NORMALIZERS or len(steps) != 2 or steps[0] != SPLIT or not bare.items() <= steps[1].items():
            return None
        if model.get("type") != "BPE" or model.get("end_of_word_suffix") != end or model.get("continuing_subword_prefix") or model.get("dropout"):
            return None
        vocab = model["vocab"]
        if not all(c in vocab and c + end in vocab for c in ByteLevel.alphabet()):
            return None
        last = np.zeros(max(vocab.values()) + 1, bool)
        last[[i for t, i in vocab.items() if t.endswith(end)]] = True
        return last

    def forget(self) -> None:
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.starts, self.lens, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    @classmethod
    def of(cls, path: str) -> "WordEncoder":
        """One encoder for a worker process, kept over tasks."""
        if path not in cls.known:
            cls.known[path] = cls(path)
        return cls.known[path]

    def _find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Place of each piece in the arrays, -1 for one not seen."""
        if not len(self.keys):
            return np.full(len(key), -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (self.checks[at] == check), at, -1)

    def _each(self, part: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids, all ids in turn) of strings encoded alone."""
        got = [x.ids for x in self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)]
        return np.fromiter(map(len, got), np.int32, len(got)), np.fromiter(chain.from_iterable(got), np.uint32)

    def _row(self, part: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same of strings that are one pre-token each, encoded in one text and told apart by their last ids."""
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.last[ids])
        if len(ends) != len(part) or ends[-1] + 1 != len(ids):
            return self._each(part)
        return np.diff(ends, prepend=-1).astype(np.int32), ids

    def _learn(self, listed: np.ndarray, single: np.ndarray, key: np.ndarray, check: np.ndarray) -> None:
        order = np.argsort(~single, kind="stable")
        listed, key, check, alone = listed[order].tolist(), key[order], check[order], int(single.sum())
        got = [self._row(listed[a : min(a + 2_000, alone)]) for a in range(0, alone, 2_000)]
        got += [self._each(listed[a : a + 20_000]) for a in range(alone, len(listed), 20_000)]
        lens = np.concatenate([n for n, _ in got])
        starts = len(self.ids) + np.cumsum(lens, dtype=np.int64) - lens
        self.ids = np.concatenate([self.ids, *(ids for _, ids in got)])
        order = np.argsort(key, kind="stable")
        to = np.searchsorted(self.keys, key[order])
        self.keys, self.checks = np.insert(self.keys, to, key[order]), np.insert(self.checks, to, check[order])
        self.starts, self.lens = np.insert(self.starts, to, starts[order]), np.insert(self.lens, to, lens[order])

    def _places(self, dictionary: pa.Array, single: np.ndarray) -> np.ndarray:
        """Place of each piece in the arrays, after learning what is new."""
        listed = dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
        digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, listed)), "<u8").reshape(-1, 2)
        order = np.argsort(digests[:, 0])
        key, check = digests[order, 0], digests[order, 1]
        at = self._find(key, check)
        new = np.flatnonzero(at < 0)
        if len(new):
            if len(self.keys) + len(new) > KEPT_WORDS:
                self.forget()
                new = np.arange(len(listed))
            self._learn(listed[order[new]], single[order[new]], key[new], check[new])
            at = self._find(key, check)
            if (at < 0).any():
                raise RuntimeError("two different words share half of a 128-bit hash")
        out = np.empty(len(at), np.int64)
        out[order] = at
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids in turn)."""
        first, codes, dictionary = words(texts)
        if not len(dictionary):
            return np.zeros(len(texts), np.int64), np.zeros(0, np.uint32)
        every = np.arange(len(dictionary) + 1)
        of_word, piece, different, single = pieces(dictionary, self.special) if self.plain else (every, every[:-1], dictionary, np.zeros(len(dictionary), bool))
        at = self._places(different, single)
        lens = self.lens[at][piece]
        ids = spread(self.ids, self.starts[at][piece], lens)
        ends = np.concatenate([[0], np.cumsum(lens)])[of_word]
        n = np.diff(ends)[codes]
        return sums(n, first), spread(ids, ends[codes], n)


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text", mode: str = "errorifexists") -> None:
    """Encode the texts, append ``end_id`` to each, and write shards to ``path`` in ascending doc_id order.

    Null ids come first, texts of equal ids in the order of a hash of the text; null texts are empty. Documents are
    dealt in ranges of (doc_id, that hash), so rows with one id do not meet in one task.
    """
    tie = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), tie.alias("tie"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    dealt = d.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order).select("doc_id", "text")

    def shards(batches):
        from pyspark import TaskContext

        enc, part, shard = WordEncoder.of(tokenizer), TaskContext.get().partitionId(), 0
        bits = bits_for(max(enc.vocabulary, end_id + 1))
        held: tuple[list, list, list] = ([], [], [])

        def cut():
            nonlocal shard, held
            names, counts, ids = held
            n = np.concatenate(counts)
            data = pack_shard(names, np.cumsum(n) - n, np.concatenate(ids), bits)
            out = pa.record_batch([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(names)], pa.int64()), pa.array([int(n.sum())], pa.int64()), pa.array([data], pa.large_binary() if len(data) > 2**30 else pa.binary())], names=["part", "shard", "n_docs", "n_tokens", "data"])
            shard, held = shard + 1, ([], [], [])
            return out

        for b in text_batches(batches, 4_000_000):
            n, ids = enc.encode(strings(b.column("text")))
            ends = np.cumsum(n)
            full = np.insert(ids, ends, end_id)
            held[0].extend(b.column("doc_id").to_pylist())
            held[1].append(n + 1)
            held[2].append(full)
            if sum(map(len, held[2])) >= SHARD_IDS:
                yield cut()
        if held[0]:
            yield cut()
        release()

    dealt.mapInArrow(shards, "part int, shard int, n_docs long, n_tokens long, data binary").write.mode(mode).option("compression", "uncompressed").parquet(path)


def read_documents(scratch: Scratch, path: str) -> DataFrame:
    """From the shards at ``path``: doc_id, start, n_tokens, ids_crc32 of each document."""
    spark = scratch.spark
    files = spark.read.parquet(path)
    sizes = files.select("part", "shard", "n_tokens")
    offsets = running_sum(scratch, sizes, [F.col("part").asc(), F.col("shard").asc()], "n_tokens", "base", name="offsets").select("part", "shard", "base")

    def rows(batches):
        for b in batches:
            for part, shard, data in zip(*(b.column(c).to_pylist() for c in ("part", "shard", "data")), strict=True):
                s = Shard(data)
                ids = s.ids(0, s.n_ids).astype("<u4")
                ends = np.append(s.firsts[1:], s.n_ids)
                crc = [zlib.crc32(ids[a:e].tobytes()) for a, e in zip(s.firsts.tolist(), ends.tolist(), strict=True)]
                yield pa.record_batch([pa.array([part] * s.n_docs, pa.int32()), pa.array([shard] * s.n_docs, pa.int32()), pa.array(s.doc_ids, pa.int64(), mask=s.has == 0), pa.array(s.firsts, pa.int64()), pa.array(ends - s.firsts, pa.int64()), pa.array(crc, pa.int64())], names=["part", "shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    read = files.select("part", "shard", "data").mapInArrow(rows, "part int, shard int, doc_id long, start long, n_tokens long, ids_crc32 long")
    return read.join(offsets, ["part", "shard"]).select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write shards to a scratch folder and return what they hold, one row per document: doc_id, start, n_tokens, ids_crc32.

    Null texts are empty and hold the end id alone; an empty table gives no rows; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    path = scratch.path("shards")
    write_shards(docs, path, tokenizer, end_id, doc_id, text)
    return read_documents(scratch, path)
