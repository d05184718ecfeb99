"""Token-ID output: documents through a byte-level BPE tokenizer into an rANS
archive (:mod:`plume.llm.rans`), and back.

Documents are range-partitioned and sorted by doc_id; each partition becomes
a segment of blocks. The ids of a first pass are stored once; their counts
over the whole corpus give the one shared frequency table; then every block
is coded by itself. Reading decodes blocks in parallel, checks their
checksums and gives each document's place and checksum.

Within a text, words between single blanks are encoded once per worker and
remembered (at most :data:`MEMO` words): the tokenizer never merges across
such a blank. Texts with other blank runs, and those that hold the content of
an added token such as ``<|endoftext|>``, go through the tokenizer whole: its
ids are those of ``encode(text, add_special_tokens=False)`` for every text.

Defined results: null and empty texts are the end id alone; the end id
follows every document; null ids come first; rows with the same doc_id are
all written, in the order of their texts. Extra columns are ignored. An empty
table gives an empty archive.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from plume.llm import rans, textbatch as tb
from plume.llm.common import as_array, pa_schema, text_columns
from plume.session import scratch_path

END_ID = 0
#: Marks a word's end that stands without a blank before it; texts that hold the character are encoded whole.
GLUE = "\x01"
#: Words a worker remembers before it starts anew.
MEMO = 1_000_000
SLICE = 6 << 20
#: Blocks coded at once.
TOGETHER = 16

_PIECES = "pieces array<struct<doc_id:long,at:long,n:long>>"
ID_BLOCKS = f"segment int, block int, first long, n long, ids binary, {_PIECES}"
BLOCKS = f"segment int, block int, first long, n long, payload binary, sections binary, crc32 long, {_PIECES}"


class WordEncoder:
    """Ids of texts, through a memory of words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.n_ids = self.tokenizer.get_vocab_size()
        self.type = np.uint16 if self.n_ids <= 1 << 16 else np.uint32
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(self.n_ids, bool)  # pieces that begin with a blank
        for piece, i in vocabulary.items():
            self.opens[i] = piece.startswith("Ġ")
        self.newline, = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.clear()

    def clear(self) -> None:
        self.code: dict[str, int] = {}
        self.ids, self.size, self.at, self.used, self.total = np.zeros(1 << 16, self.type), np.zeros(1 << 12, np.int64), \
            np.zeros(1 << 12, np.int64), 0, 0

    def _learn(self, words: list[str]) -> None:
        """Encode new words as they stand after a blank. A key that begins with a newline stands for just that, one that
        begins with GLUE for what follows it, without a blank."""
        glued = [word for word in words if word[:1] == GLUE]
        if glued:
            ids = [np.array(x.ids, self.type) for x in
                   self.tokenizer.encode_batch_fast([word[1:] for word in glued], add_special_tokens=False)]
            self._store(glued, np.concatenate(ids), np.array([len(x) for x in ids], np.int64))
        lines = [word for word in words if word[:1] == "\n"]
        if lines:
            self._store(lines, *self._encode(lines, "\n"))
        rest = [word for word in words if word[:1] not in (GLUE, "\n")] if glued or lines else words
        if rest:
            self._store(rest, *self._encode(rest, " "))

    def _encode(self, words: list[str], mark: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each word has). Many words go in one line; a word's ids begin at each piece that opens
        with a blank, or at each newline."""
        flat, sizes = [], []
        for i in range(0, len(words), 4096):
            chunk = words[i:i + 4096]
            lines = [" " + " ".join(chunk[k:k + 32]) if mark == " " else "".join(chunk[k:k + 32])
                     for k in range(0, len(chunk), 32)]
            ids: list[int] = []
            for line in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False):
                ids += line.ids
            own = np.array(ids, self.type)
            starts = np.flatnonzero(self.opens[own] if mark == " " else own == self.newline)
            if len(starts) != len(chunk):
                raise ValueError("the tokenizer does not keep words apart at blanks")
            flat.append(own)
            sizes.append(np.diff(np.append(starts, len(own))))
        return np.concatenate(flat), np.concatenate(sizes)

    def _store(self, words: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        n, m = self.used + len(words), self.total + len(ids)
        while len(self.size) < n:
            self.size, self.at = np.resize(self.size, 2 * len(self.size)), np.resize(self.at, 2 * len(self.at))
        while len(self.ids) < m:
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.size[self.used:n] = size
        self.at[self.used:n] = self.total + np.cumsum(size) - size
        self.ids[self.total:m] = ids
        self.code.update(zip(words, range(self.used, n), strict=True))
        self.used, self.total = n, m

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each text has), without end ids."""
        column = column.fill_null("").cast(pa.large_string())
        odd = pc.match_substring_regex(column, r"(?:^|\s) |\s$| \s|[\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
        odd = odd.to_numpy(zero_copy_only=False) | (pc.binary_length(column).to_numpy() == 0)
        for content in (*self.added, GLUE):
            odd = odd | pc.match_substring(column, content).to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(~odd)
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(plain):
            split = pc.split_pattern(_apart(column.take(pa.array(plain)) if odd.any() else column), " ")
            bounds = np.asarray(split.offsets)
            words = split.flatten().dictionary_encode()
            known = words.dictionary.to_pylist()
            if self.used > MEMO:
                self.clear()
            # A text's first word stands after no blank: it is encoded by itself.
            index = np.asarray(words.indices)
            later = np.ones(len(index), bool)
            later[bounds[:-1] - bounds[0]] = False
            used = np.zeros(len(known), bool)
            used[index[later]] = True
            code = np.fromiter(map(self.code.get, known, repeat(-1)), np.int64, len(known))
            missing = np.flatnonzero((code < 0) & used)
            if len(missing):
                new = [known[i] for i in missing]
                self._learn(new)
                code[missing] = np.fromiter(map(self.code.__getitem__, new), np.int64, len(new))
            code = code[index]
            heads = words.take(pa.array(bounds[:-1] - bounds[0])).cast(pa.large_string()).to_pylist()
            head_ids = [np.array(x.ids, self.type) for x in
                        self.tokenizer.encode_batch_fast(heads, add_special_tokens=False)]
            size = np.where(later, self.size[code], 0)
            head_size = np.array([len(x) for x in head_ids], np.int64)
            out, total = _put_together(np.concatenate(head_ids), head_size, _gather(self.ids, self.at[code], size),
                                       np.add.reduceat(size, bounds[:-1] - bounds[0]))
            parts.append((plain, out, total))
        if odd.any():
            at = np.flatnonzero(odd)
            ids = [np.array(x.ids, self.type) for x in self.tokenizer.encode_batch_fast(
                column.take(pa.array(at)).to_pylist(), add_special_tokens=False)]
            parts.append((at, np.concatenate(ids), np.array([len(x) for x in ids], np.int64)))
        if len(parts) == 1:
            return parts[0][1], parts[0][2]
        counts = np.zeros(len(column), np.int64)
        pieces: list[np.ndarray] = [np.zeros(0, self.type)] * len(column)
        for at, ids, size in parts:
            counts[at] = size
            for i, own in zip(at, np.split(ids, np.cumsum(size)[:-1]), strict=True):
                pieces[i] = own
        return (np.concatenate(pieces) if pieces else np.zeros(0, self.type)), counts


def _apart(column: pa.Array) -> pa.Array:
    """Blanks where the tokenizer keeps characters apart anyway, so that words are not learned anew with every line end
    and mark beside them: before a newline between two characters that are no blanks, and (with GLUE) before a full stop
    or comma behind an ASCII letter."""
    texts = tb.as_texts(column)
    data = texts.data
    if len(data) < 3:
        return column
    inside = np.ones(len(data) + 1, bool)
    inside[texts.bounds] = False  # the first character of a text
    before, after = data[:-2], data[2:]
    own = data[1:-1]
    line = (own == 0x0A) & (before > 0x20) & (after > 0x20) & inside[1:-2] & inside[2:-1]
    mark = ((own == 0x2E) | (own == 0x2C)) & ((before | 0x20) >= 0x61) & ((before | 0x20) <= 0x7A) & inside[1:-2]
    at, glue = np.flatnonzero(line) + 1, np.flatnonzero(mark) + 1
    # Where a text holds other blanks too, or empty lines, a piece from a newline on might hold more than one blank.
    blank = np.concatenate([[0], np.cumsum((data == 0x09) | ((data >= 0x0B) & (data <= 0x0D)) | ((data == 0x0A) & (np.append(data[1:], 0) == 0x0A)))])
    simple = blank[texts.bounds[1:]] == blank[texts.bounds[:-1]]
    at = at[simple[np.searchsorted(texts.bounds, at, "right") - 1]]
    added = np.concatenate([at, np.repeat(glue, 2)])
    order = np.argsort(added, kind="stable")
    filled = np.concatenate([np.full(len(at), 0x20, np.uint8), np.tile(np.array([0x20, ord(GLUE)], np.uint8), len(glue))])
    added = added[order]
    bounds = texts.bounds + np.searchsorted(added, texts.bounds)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(bounds), pa.py_buffer(np.insert(data, added, filled[order])))


def _gather(ids: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Runs ids[at:at + size], one behind the other."""
    return ids[np.repeat(at - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]


def _put_together(heads: np.ndarray, head_size: np.ndarray, tails: np.ndarray,
                  tail_size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each head followed by its tail: (ids, sizes)."""
    sizes = np.stack([head_size, tail_size], 1).ravel()
    is_head = np.repeat(np.tile([True, False], len(head_size)), sizes)
    out = np.empty(len(is_head), heads.dtype)
    out[is_head], out[~is_head] = heads, tails
    return out, head_size + tail_size


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One for each worker and file; the memory stays from batch to batch."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _id_blocks(path: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        segment = TaskContext.get().partitionId()
        waiting = np.zeros(0, own.type)
        pieces: list[dict] = []
        first = block = number = 0

        for part in tb.slices(batches, limit=SLICE):
            ids, counts = own.encode(part.column("text"))
            full = np.full(len(ids) + len(counts), END_ID, own.type)
            ends = np.cumsum(counts + 1) - 1
            body = np.ones(len(full), bool)
            body[ends] = False
            full[body] = ids
            waiting = np.concatenate([waiting, full])
            for doc_id, n in zip(part.column("doc_id").to_pylist(), (counts + 1).tolist(), strict=True):
                pieces.append({"doc_id": doc_id, "at": number, "n": n})
                number += 1
            n_full = len(waiting) // rans.BLOCK
            if n_full:
                rows = _rows(waiting[:n_full * rans.BLOCK], pieces, segment, block, first)
                pieces = _rest(pieces, n_full * rans.BLOCK)
                block, first = block + n_full, first + n_full * rans.BLOCK
                waiting = waiting[n_full * rans.BLOCK:]
                yield _batch(rows, schema)
        if len(waiting):
            yield _batch(_rows(waiting, pieces, segment, block, first), schema)

    return run


def _rows(ids: np.ndarray, pieces: list[dict], segment: int, block: int, first: int) -> list[dict]:
    """Blocks of consecutive ids with the pieces of documents that each holds."""
    sizes = np.array([p["n"] for p in pieces], np.int64)
    begin = np.cumsum(sizes) - sizes
    out = []
    for lo in range(0, len(ids), rans.BLOCK):
        own = ids[lo:lo + rans.BLOCK]
        hi = lo + len(own)
        a, b = int(np.searchsorted(begin + sizes, lo, "right")), int(np.searchsorted(begin, hi, "left"))
        inside = [pieces[i] | {"n": int(min(hi, begin[i] + sizes[i]) - max(lo, begin[i]))} for i in range(a, b)]
        out.append({"segment": segment, "block": block, "first": first + lo, "n": len(own), "ids": own.tobytes(),
                    "pieces": inside})
        block += 1
    return out


def _rest(pieces: list[dict], used: int) -> list[dict]:
    """The pieces, or parts of them, behind the first ``used`` ids."""
    ends = np.cumsum([p["n"] for p in pieces])
    at = int(np.searchsorted(ends, used, "right"))
    if at == len(pieces):
        return []
    return [pieces[at] | {"n": int(ends[at]) - used}, *pieces[at + 1:]]


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def _write(df: DataFrame, path: str) -> None:
    df.write.option("compression", "zstd").option("parquet.enable.dictionary", "false").parquet(path)


def write_archive(docs: DataFrame, tokenizer_path: str, path: str | None = None) -> str:
    """Encode all documents into an archive; gives its path (by default in the shared folder)."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    kind = np.dtype(encoder(tokenizer_path).type)
    n_ids = encoder(tokenizer_path).n_ids
    ordered = text_columns(docs, "doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    _write(ordered.mapInArrow(_id_blocks(tokenizer_path, pa_schema(spark, ID_BLOCKS)), ID_BLOCKS), f"{path}/ids")
    ids = spark.read.schema(ID_BLOCKS).parquet(f"{path}/ids")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_ids, np.int64)
        for part in batches:
            for own in part.column("ids").to_pylist():
                total += np.bincount(np.frombuffer(own, kind), minlength=n_ids)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["id", "n"])

    rows = ids.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(
        F.sum("n").alias("n")).toPandas()  # as many rows as the vocabulary
    counts = np.zeros(n_ids, np.int64)
    counts[rows["id"].to_numpy()] = rows["n"].to_numpy()
    frequency = rans.quantise(counts)
    known = np.flatnonzero(frequency)
    spark.createDataFrame(pa.table({"id": known.astype(np.int32), "frequency": frequency[known]})).coalesce(
        1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast(frequency)  # as large as the vocabulary
    schema = pa_schema(spark, BLOCKS)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table.of(shared.value)
        for part in _few(batches):
            coded = rans.encode([np.frombuffer(x, kind) for x in part.column("ids").to_pylist()], table)
            own = {"payload": [x[0] for x in coded], "sections": [x[1] for x in coded], "crc32": [x[2] for x in coded]}
            yield pa.RecordBatch.from_arrays(
                [as_array(own[f.name], f.type) if f.name in own else part.column(f.name).cast(f.type) for f in schema],
                schema=schema)

    _write(ids.mapInArrow(code, BLOCKS), f"{path}/blocks")
    return path


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        for at in range(0, part.num_rows, TOGETHER):
            yield part.slice(at, TOGETHER)


PIECES = "segment int, at long, doc_id long, first long, n long, crc32 long"


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Each document's place and checksum, from the decoded blocks."""
    table = spark.read.parquet(f"{path}/table").toPandas()  # as many rows as the vocabulary
    frequency = np.zeros(int(table["id"].max()) + 1 if len(table) else 0, np.int64)
    frequency[table["id"].to_numpy()] = table["frequency"].to_numpy()
    shared = spark.sparkContext.broadcast(frequency)
    schema = pa_schema(spark, PIECES)
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = rans.Table.of(shared.value)
        for part in _few(batches):
            coded = [part.column(c).to_pylist() for c in ("payload", "sections", "n", "crc32")]
            rows = []
            for ids, segment, first, pieces in zip(
                    rans.decode(list(zip(*coded, strict=True)), own),
                    *(part.column(c).to_pylist() for c in ("segment", "first", "pieces")), strict=True):
                little = np.ascontiguousarray(ids, "<u4")
                at = 0
                for p in pieces:
                    rows.append((segment, p["at"], p["doc_id"], first + at, p["n"],
                                 rans.checksum(little[at:at + p["n"]])))
                    at += p["n"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    pieces = blocks.mapInArrow(restore, PIECES)

    @F.pandas_udf("long")
    def join_checksums(parts):
        def one(own) -> int:
            crc = 0
            for p in own:
                crc = rans.crc32_combine(crc, int(p["crc32"]), 4 * int(p["n"])) if crc or len(own) > 1 else int(p["crc32"])
            return crc

        return parts.map(one)

    documents = pieces.groupBy("segment", "at").agg(
        F.first("doc_id").alias("doc_id"), F.min("first").alias("first"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("first", "n", "crc32"))).alias("parts"))
    # One row a segment: the ids before it.
    from pyspark.sql import Window

    base = blocks.groupBy("segment").agg(F.sum("n").alias("n")).select(
        "segment", (F.sum("n").over(Window.orderBy("segment")) - F.col("n")).alias("base"))
    return documents.join(base, "segment").select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens",
        join_checksums("parts").alias("ids_crc32"))
