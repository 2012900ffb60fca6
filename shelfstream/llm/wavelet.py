"""Token-ID output as wavelet matrices, one compressed succinct file row per shard.

A shard holds the ids of consecutive documents.  Its alphabet is the ids that occur in it, the most frequent first, and the
sequence of their ranks is stored as one bit plane per bit of the largest rank: the plane's bits in order, then the sequence
split stably into zeros and ones for the next plane.  Frequent ids have leading zeros, so the upper planes are nearly empty
and compress well.  The shard also keeps a running count of ones per block of each plane, so ``access``, ``rank`` and
``select`` look at one block of each packed plane; :func:`count_tokens`, :func:`find_tokens` and :func:`tokens_at` ask them of
written shards without decoding these.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfstream.llm.ragged import RaggedCache, gathered, in_blocks, per_list
from shelfstream.session import fresh_path, materialize

END_ID = 1
SHARD_TOKENS = 1 << 20
RANK_BLOCK = 512  # bits for each running count
#: Words of characters that normalisation only lower-cases, without the apostrophe; and the pre-tokens of such words, which
#: line feeds part.
PLAIN = "^[!-&(-{}~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+$"
PART = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|\n|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff\n]+")
#: Byte-level letters of the two-byte characters in PLAIN: every byte from 0xA1 on stands for itself, 0x80 to 0xA0 follow
#: 0x100 in their order after the 33 low ones; 0xAD comes last.
BYTE_LEVEL = {c: "".join(chr(b + 0xA2) if b <= 0xA0 else chr(0x143) if b == 0xAD else chr(b) for b in chr(c).encode()) for c in range(0xC0, 0x100)}
#: Texts for the library as a whole: special tokens, and separators on which the two kinds of white space differ.
WHOLE = r"<\||[\x1c-\x1f]"
SHARD_SCHEMA = (
    "first_doc long, seq long, docs array<long>, lengths array<int>, n_tokens long, alphabet binary, planes array<binary>, "
    "counts array<binary>"
)


class WaveletMatrix:
    """Packed planes from the top bit down, and the ones of each before every block and at its end."""

    def __init__(self, size: int, alphabet: np.ndarray, planes: list[bytes], counts: list[bytes]):
        self.size, self.alphabet, self.planes, self.counts = size, alphabet, planes, counts
        self.bits = len(planes)
        self._planes = [np.frombuffer(p, np.uint8) for p in planes]
        self._before = [np.frombuffer(c, "<u4") for c in counts]
        self._zeros = [size - int(c[-1]) for c in self._before]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        counts = np.bincount(ids)
        alphabet = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)].astype("<u4")
        rank = np.zeros(len(counts), np.uint32)
        rank[alphabet] = np.arange(len(alphabet), dtype=np.uint32)
        current = rank[ids].astype(np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
        planes, counts = [], []
        for bit in range(max(len(alphabet) - 1, 0).bit_length() - 1, -1, -1):
            ones = (current & current.dtype.type(1 << bit)).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            planes.append(packed.tobytes())
            per_block = np.add.reduceat(np.bitwise_count(packed), np.arange(0, len(packed), RANK_BLOCK // 8), dtype=np.uint32)
            counts.append(np.concatenate(([0], np.cumsum(per_block))).astype("<u4").tobytes())
            current = np.concatenate((np.compress(np.logical_not(ones), current), np.compress(ones, current)))
        return cls(len(ids), alphabet, planes, counts)

    def to_ids(self) -> np.ndarray:
        """The whole sequence, rebuilt from the last plane upwards."""
        kind = np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32
        current = np.zeros(self.size, kind)
        for k in range(self.bits - 1, -1, -1):
            ones = np.unpackbits(np.frombuffer(self.planes[k], np.uint8), count=self.size, bitorder="little").view(bool)
            earlier = np.empty(self.size, kind)
            earlier[np.flatnonzero(~ones)] = current[: self._zeros[k]]
            earlier[np.flatnonzero(ones)] = current[self._zeros[k] :] | kind(1 << (self.bits - 1 - k))
            current = earlier
        return self.alphabet[current] if self.size else np.empty(0, np.uint32)

    def _bit(self, k: int, position: int) -> int:
        return int(self._planes[k][position >> 3]) >> (position & 7) & 1

    def _ones(self, k: int, position: int) -> int:
        """Ones of plane k before the position: the block's running count and the bits of its bytes."""
        block, byte = position // RANK_BLOCK, position >> 3
        ones = int(self._before[k][block]) + int(np.bitwise_count(self._planes[k][block * (RANK_BLOCK // 8) : byte]).sum())
        return ones + ((int(self._planes[k][byte]) & (1 << (position & 7)) - 1).bit_count() if position & 7 else 0)

    def access(self, position: int) -> int:
        value = 0
        for k in range(self.bits):
            ones, bit = self._ones(k, position), self._bit(k, position)
            position = self._zeros[k] + ones if bit else position - ones
            value = value << 1 | bit
        return int(self.alphabet[value])

    def _value(self, token: int) -> int:
        found = np.flatnonzero(self.alphabet == token)
        return int(found[0]) if len(found) else -1

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """Where the value's occurrences before ``end`` lie after the last plane."""
        low, high = 0, end
        for k in range(self.bits):
            a, b = self._ones(k, low), self._ones(k, high)
            if value >> (self.bits - 1 - k) & 1:
                low, high = self._zeros[k] + a, self._zeros[k] + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, token: int, end: int) -> int:
        """Occurrences of the token before position ``end``."""
        value = self._value(token)
        low, high = self._range(value, end) if value >= 0 else (0, 0)
        return high - low

    def _nth(self, k: int, bit: int, nth: int) -> int:
        """Position of the nth one or zero of plane k: its block by bisection, then one block's bits."""
        before = self._before[k]
        if not bit:
            before = np.minimum(np.arange(len(before)) * RANK_BLOCK, self.size) - before
        block = int(np.searchsorted(before, nth, side="right")) - 1
        own = self._planes[k][block * (RANK_BLOCK // 8) : (block + 1) * (RANK_BLOCK // 8)]
        return block * RANK_BLOCK + int(np.flatnonzero(np.unpackbits(own, bitorder="little") == bit)[nth - int(before[block])])

    def select(self, token: int, nth: int) -> int:
        """Position of the token's nth occurrence (from 0), or -1."""
        value = self._value(token)
        low, high = self._range(value, self.size) if value >= 0 else (0, 0)
        if nth >= high - low:
            return -1
        position = low + nth
        for k in range(self.bits - 1, -1, -1):
            bit = value >> (self.bits - 1 - k) & 1
            position = self._nth(k, bit, position - (self._zeros[k] if bit else 0))
        return position

    def positions(self, token: int) -> np.ndarray:
        """All positions of the token in order, a plane at a time."""
        value = self._value(token)
        low, high = self._range(value, self.size) if value >= 0 else (0, 0)
        found = np.arange(low, high)
        for k in range(self.bits - 1, -1, -1) if len(found) else ():
            bit = value >> (self.bits - 1 - k) & 1
            bits = np.unpackbits(self._planes[k], count=self.size, bitorder="little")
            found = np.flatnonzero(bits == bit)[found - (self._zeros[k] if bit else 0)]
        return found


#: The normalizer and pre-tokenizer that PLAIN, PART and BYTE_LEVEL follow, as a tokenizer file states them.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"},
]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]}


class WordTokenizer:
    """Whole-text encoding of a ``tokenizers`` file whose pre-tokens never span ASCII white space.

    The distinct words of a block that are plain letters, digits and signs are cut where the file's own pattern cuts them, all
    in one pass, and each part is left to the library's merge model; other words go through its whole chain.  Both are
    remembered up to a bound.  A text with one of the separators that Python alone calls white space goes to the library
    whole, and so does every text if the file states another normalizer or pre-tokenizer.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        stated = json.loads(self.library.to_str())
        self.by_words = (stated["normalizer"], stated["pre_tokenizer"]) == (NORMALIZER, PRE_TOKENIZER)
        self.parts = RaggedCache(self._merged, 500_000)
        self.others = RaggedCache(self._chained, 200_000)

    def _merged(self, parts: list[str]) -> Iterator[list[int]]:
        tokenize = self.library.model.tokenize
        for part in parts:
            yield [] if part == "\n" else [t.id for t in tokenize(part if part.isascii() else part.translate(BYTE_LEVEL))]

    def _chained(self, words: list[str]) -> list[list[int]]:
        return [found.ids for found in self.library.encode_batch_fast(words, add_special_tokens=False)]

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each word has."""
        plain = pc.match_substring_regex(words, PLAIN)
        mask = plain.to_numpy(zero_copy_only=False)
        ids, lengths = self.others.runs(self.others.rows(words.filter(pc.invert(plain)).to_pylist()))
        if not mask.any():
            return ids, lengths
        own = words.filter(plain)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own), "\n")[0].as_py()
        rows = self.parts.rows(PART.findall(joined.lower() + "\n"))
        own_ids, own_lengths = self.parts.runs(rows)
        ends = np.cumsum(own_lengths)[rows == rows[-1]]  # the last part is a line feed
        every = np.empty(len(words), np.int64)
        every[mask], every[~mask] = np.diff(ends, prepend=0), lengths
        inside, flat = np.repeat(mask, every), np.empty(len(ids) + len(own_ids), np.int32)
        flat[inside], flat[~inside] = own_ids, ids
        return flat, every

    def encode_many(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of every text; nulls count as empty."""
        out: list[np.ndarray] = []
        for block in in_blocks(pc.fill_null(texts, ""), 4 << 20):
            whole = pc.match_substring_regex(block, WHOLE).to_numpy(zero_copy_only=False) | (not self.by_words)
            words = pc.ascii_split_whitespace(pc.if_else(pa.array(whole), "", block))
            coded = words.flatten().dictionary_encode()
            flat, lengths = self._distinct(coded.dictionary)
            ends = np.cumsum(lengths)
            index = coded.indices.to_numpy(zero_copy_only=False)
            own = per_list(words, *gathered(flat, (ends - lengths)[index], ends[index]))
            for k, ids in zip(np.flatnonzero(whole), self._chained(block.filter(pa.array(whole)).to_pylist()), strict=True):
                own[k] = np.array(ids, np.int32)
            out += own
        return out


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, text: str = "text", doc_id: str = "doc_id",
                 shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode every row, append the end id, and write shards in ascending id order to the folder ``path``.

    Null texts count as empty, null ids come first, and rows of one id stay together in any order.  A document longer
    than ``shard_tokens`` has a shard of its own.  Range partitions are cut again where an id's rows are many.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = tokenizer(tokenizer_path), np.array([END_ID], np.int32)
        ids: list[np.ndarray] = []
        owners: list[int | None] = []
        held = seq = 0

        def shard() -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.concatenate(ids))
            row = {
                "first_doc": owners[0], "seq": seq, "docs": list(owners), "lengths": [len(x) for x in ids], "n_tokens": held,
                "alphabet": matrix.alphabet.tobytes(), "planes": matrix.planes, "counts": matrix.counts,
            }
            return pa.RecordBatch.from_pylist([row], schema=ARROW_SHARD)

        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for at in range(0, len(keys), 2048):
                for key, own in zip(keys[at : at + 2048], encoder.encode_many(batch.column("text").slice(at, 2048)), strict=True):
                    own = np.concatenate((own, end))
                    if ids and held + len(own) > shard_tokens:
                        yield shard()
                        ids, owners, held, seq = [], [], 0, seq + 1
                    ids.append(own)
                    owners.append(key)
                    held += len(own)
        if ids:
            yield shard()

    (
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id")
        .mapInArrow(encode, SHARD_SCHEMA)
        .write.option("compression", "zstd").parquet(path)
    )


ARROW_SHARD = pa.schema([
    ("first_doc", pa.int64()), ("seq", pa.int64()), ("docs", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())),
    ("n_tokens", pa.int64()), ("alphabet", pa.binary()), ("planes", pa.list_(pa.binary())), ("counts", pa.list_(pa.binary())),
])


def read_matrix(row) -> WaveletMatrix:
    """The wavelet matrix of one shard row."""
    return WaveletMatrix(row["n_tokens"], np.frombuffer(row["alphabet"], "<u4"), list(row["planes"]), list(row["counts"]))


def _starts(shards: DataFrame) -> DataFrame:
    """(first_doc, seq, before): the ids of all shards before each, summed within ranges of shards and over the ranges."""
    order = [F.col("first_doc").asc_nulls_first(), F.col("seq")]
    partitions = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = shards.select("first_doc", "seq", "n_tokens").repartitionByRange(partitions, *order)
    heads = materialize(dealt.withColumn("part", F.spark_partition_id()), "shard-heads")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = heads.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier.orderBy("part")), F.lit(0)).alias("base")
    )
    inside = F.coalesce(F.sum("n_tokens").over(earlier.partitionBy("part").orderBy(*order)), F.lit(0))
    return heads.withColumn("inside", inside).join(parts, "part").select("first_doc", "seq", (F.col("base") + F.col("inside")).alias("before"))


def _ask(shards: DataFrame, answer: Callable[[dict], Iterator[tuple]], schema: str) -> DataFrame:
    """The rows that ``answer`` gives for each shard, which stays packed."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                for columns in answer(batch.slice(k, 1).to_pylist()[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    names = [field.split()[0] for field in schema.split(", ")]
    return shards.mapInArrow(ask, schema)


def count_tokens(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """(token, n): how often each of the tokens occurs in the files, by rank; tokens that do not occur have zero."""
    wanted = sorted(set(tokens))

    def answer(row: dict) -> Iterator[tuple]:
        matrix = read_matrix(row)
        yield wanted, [matrix.rank(t, matrix.size) for t in wanted]

    found = _ask(spark.read.parquet(path).select("n_tokens", "alphabet", "planes", "counts"), answer, "token long, n long")
    every = spark.createDataFrame([(t, 0) for t in wanted], "token long, n long")
    return found.unionByName(every).groupBy("token").agg(F.sum("n").alias("n"))


def find_tokens(spark: SparkSession, path: str, tokens: list[int]) -> DataFrame:
    """(token, doc_id, position): all occurrences of the tokens, counted from 0 within the document, by select."""
    wanted = sorted(set(tokens))

    def answer(row: dict) -> Iterator[tuple]:
        matrix, ends, docs = read_matrix(row), np.cumsum(row["lengths"]), np.array(row["docs"], object)
        for token in wanted:
            at = matrix.positions(token)
            owner = np.searchsorted(ends, at, side="right")
            yield [token] * len(at), docs[owner].tolist(), at - (ends - row["lengths"])[owner]

    shards = spark.read.parquet(path).select("docs", "lengths", "n_tokens", "alphabet", "planes", "counts")
    return _ask(shards, answer, "token long, doc_id long, position long")


def tokens_at(spark: SparkSession, path: str, positions: list[int]) -> DataFrame:
    """(position, token): the ids at positions of the whole files, counted from 0, by access; others beyond the end are left out."""
    wanted = np.unique(np.array(positions, np.int64))

    def answer(row: dict) -> Iterator[tuple]:
        own = wanted[(wanted >= row["before"]) & (wanted < row["before"] + row["n_tokens"])]
        matrix = read_matrix(row)
        yield own, [matrix.access(int(p) - row["before"]) for p in own]

    shards = spark.read.parquet(path).select("first_doc", "seq", "n_tokens", "alphabet", "planes", "counts").alias("d")
    on = F.col("d.first_doc").eqNullSafe(F.col("b.first_doc")) & (F.col("d.seq") == F.col("b.seq"))
    near = shards.join(_starts(shards).alias("b"), on).select("d.n_tokens", "d.alphabet", "d.planes", "d.counts", "b.before")
    return _ask(near, answer, "position long, token long")


def read_tokens(spark, path: str, with_ids: bool = False) -> DataFrame:
    """Documents of the shards: doc_id, start, n_tokens, ids_crc32 and, with ``with_ids``, the ids themselves."""
    shards = spark.read.parquet(path)
    schema = "first_doc long, seq long, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                ids = read_matrix(row).to_ids().astype("<u4")
                ends = np.cumsum(row["lengths"])
                starts = ends - row["lengths"]
                own = [ids[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
                columns = [
                    pa.array([row["first_doc"]] * len(own), pa.int64()), pa.array([row["seq"]] * len(own), pa.int64()),
                    pa.array(row["docs"], pa.int64()), pa.array(starts, pa.int64()), pa.array(row["lengths"], pa.int64()),
                    pa.array([zlib.crc32(x) for x in own], pa.int64()),
                ]
                names = ["first_doc", "seq", "doc_id", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(own, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    before = _starts(shards)
    on = F.col("d.first_doc").eqNullSafe(F.col("b.first_doc")) & (F.col("d.seq") == F.col("b.seq"))
    return (
        shards.mapInArrow(decode, schema).alias("d").join(before.alias("b"), on)
        .select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
    )


def token_files(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the shards to the shared folder and read the documents back from them."""
    path = fresh_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_path)
    return read_tokens(docs.sparkSession, path)
