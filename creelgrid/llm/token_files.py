"""Token ids in Arrow stream files: batches of equal-length sequences and their masks."""

from __future__ import annotations

import os
import uuid
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from creelgrid.session import shared_dir, stage_table

from .base import by_size, remembers, working
from .units import UnitCache

#: Ids per sequence and sequences per record batch.
LENGTH, ROWS = 2048, 256


def file_schema(length: int, vocabulary: int) -> pa.Schema:
    """ids, and two bit masks: ``real`` (no padding) and ``first`` (first id of a document)."""
    kind = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()
    bits = pa.list_(pa.field("item", pa.bool_(), nullable=False), length)
    ids = pa.list_(pa.field("item", kind, nullable=False), length)
    return pa.schema([pa.field("ids", ids, nullable=False), pa.field("real", bits, nullable=False), pa.field("first", bits, nullable=False)])


class SequenceWriter:
    """Packs documents one after the other; the last sequence of a file is padded."""

    def __init__(self, sink, schema: pa.Schema, rows: int = ROWS):
        self.schema, self.length = schema, schema.field("ids").type.list_size
        self.kind = schema.field("ids").type.value_type.to_pandas_dtype()
        self.stream, self.block = pa.ipc.new_stream(sink, schema), rows * self.length
        self.ids, self.starts, self.held, self.total = [], [], 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.starts.append(self.held)
        self.ids.append(ids.astype(self.kind))
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= self.block:
            self._flush(self.held - self.held % self.block)

    def _flush(self, upto: int) -> None:
        ids = np.concatenate([*self.ids, np.zeros(max(0, upto - self.held), self.kind)])
        starts = np.array(self.starts, np.int64)
        real, first = np.arange(upto) < self.held, np.zeros(upto, bool)
        first[starts[starts < upto]] = True
        for k in range(0, upto, self.block):
            part = slice(k, min(k + self.block, upto))
            self.stream.write_batch(
                pa.RecordBatch.from_arrays(
                    [pa.FixedSizeListArray.from_arrays(pa.array(x[part], t.type.value_type), type=t.type) for x, t in zip((ids, real, first), self.schema)],
                    schema=self.schema,
                )
            )
        self.ids, self.starts = [ids[upto:]], (starts[starts >= upto] - upto).tolist()
        self.held = max(0, self.held - upto)

    def close(self) -> None:
        if self.held:
            self._flush(-(-self.held // self.length) * self.length)
        self.stream.close()


class SequenceFile:
    """Random access to the sequences of one local file: views into the mapped file, nothing is copied."""

    def __init__(self, path: str):
        self.batches = list(pa.ipc.open_stream(pa.memory_map(path)))
        self.rows = self.batches[0].num_rows if self.batches else 0
        self.count = sum(b.num_rows for b in self.batches)

    def __len__(self) -> int:
        return self.count

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids of sequence ``i`` and its mask of real ids."""
        if not 0 <= i < self.count:
            raise IndexError(i)
        batch, row = self.batches[i // self.rows], i % self.rows
        length = batch.schema.field("ids").type.list_size
        ids, real = (batch.column(k).flatten() for k in ("ids", "real"))
        return ids.to_numpy()[row * length : (row + 1) * length], real.slice(row * length, length)


@lru_cache(2)
def _cache(path: str) -> tuple[UnitCache, int]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    # A token of a byte-level vocabulary has a character per byte.
    widths = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for token, i in tokenizer.get_vocab().items():
        widths[i] = len(token)

    def encode(texts: list[str]) -> list[bytes]:
        """Units that begin with a blank and do not end in one are encoded many at a time, as one text; the
        widths of the tokens tell where each ends."""
        out: list[bytes] = [b""] * len(texts)
        joined = [i for i, t in enumerate(texts) if t[:1] == " " and not t[-1].isspace()]
        groups = [joined[k : k + 256] for k in range(0, len(joined), 256)]
        alone = sorted(set(range(len(texts))) - set(joined))
        found = tokenizer.encode_batch_fast(["".join([texts[i] for i in g]) for g in groups], add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(coded.ids for coded in found), "<u4")
        sizes = [len(t) if t.isascii() else len(t.encode()) for t in map(texts.__getitem__, joined)]
        ends = (np.searchsorted(np.cumsum(widths[ids]), np.cumsum(sizes)) * 4 + 4).tolist() if sizes else []
        flat = ids.tobytes()
        for i, a, b in zip(joined, [0, *ends], ends):
            out[i] = flat[a:b]
        for i, coded in zip(alone, tokenizer.encode_batch_fast([texts[i] for i in alone], add_special_tokens=False)):
            out[i] = np.array(coded.ids, "<u4").tobytes()
        return out

    return UnitCache(encode), tokenizer.get_vocab_size()


remembers("token_files", _cache.cache_clear)


def _open(path: str):
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)


def write_tokens(
    docs: DataFrame, path: str, folder: str, end_id: int = 0, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode texts with the tokenizer file ``path`` and write them in ascending id order.

    Returns one row per file: shard, n_ids, n_docs. A range of ids is a file ``shard-NNNNN.arrow``, with
    the ids of its documents in ``shard-NNNNN.docs.arrow``; null ids come first, and rows of one id are
    ordered by text. A task writes under a name of its own and renames at the end, so a repeated task
    replaces its file by the same one. Null and empty texts are the end id alone. An empty table writes
    no file. Memory holds one slice of texts and one record batch.
    """
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        context = TaskContext.get()
        shard, store_path = context.partitionId(), None
        writer = docs_writer = sink = docs_sink = None
        n_docs = 0
        working("token_files")
        cache, vocabulary = _cache(path)
        end = np.array([end_id], np.uint32)
        for batch in by_size(batches):
            if writer is None:
                store, base = _open(folder)
                store.create_dir(base, recursive=True)
                mark = f".attempt-{context.taskAttemptId()}-{uuid.uuid4().hex}"
                store_path = f"{base}/shard-{shard:05d}"
                sink, docs_sink = (store.open_output_stream(f"{store_path}{x}{mark}") for x in (".arrow", ".docs.arrow"))
                writer = SequenceWriter(sink, file_schema(length, vocabulary))
                docs_writer = pa.ipc.new_stream(docs_sink, pa.schema([batch.schema.field("doc_id")]))
            for ids in cache.texts(batch.column("text")):
                writer.add(np.concatenate([np.frombuffer(ids, "<u4"), end]))
            docs_writer.write_batch(batch.select(["doc_id"]))
            n_docs += batch.num_rows
        if writer is None:
            return
        writer.close(), docs_writer.close(), sink.close(), docs_sink.close()
        for x in (".docs.arrow", ".arrow"):
            store.move(f"{store_path}{x}{mark}", f"{store_path}{x}")
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64()), "n_ids": pa.array([writer.total], pa.int64()), "n_docs": pa.array([n_docs], pa.int64())})

    ordered = picked.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    return stage_table(ordered.mapInArrow(run, "shard long, n_ids long, n_docs long"), "shards")


def read_tokens(shards: DataFrame, folder: str, id_type: str = "long") -> DataFrame:
    """Read the files back: doc_id, start, n_tokens, ids_crc32, in no order; one row per document.

    Each file is read by one task in batches; documents are told apart by the mask of first ids alone.
    """

    def run(batches):
        store, base = _open(folder)
        for shard, start in ((s, t) for b in batches for s, t in zip(b.column("shard").to_pylist(), b.column("start").to_pylist())):
            with store.open_input_file(f"{base}/shard-{shard:05d}.docs.arrow") as f:
                names = pa.ipc.open_stream(f).read_all().column("doc_id").combine_chunks()
            counts, crcs = [], []
            with store.open_input_file(f"{base}/shard-{shard:05d}.arrow") as f:
                for batch in pa.ipc.open_stream(f):
                    ids, real, first = (c.flatten().to_numpy(zero_copy_only=False) for c in batch.columns)
                    ids = ids[: int(np.count_nonzero(real))].astype("<u4")
                    cuts = np.flatnonzero(first[: len(ids)]).tolist()
                    if len(ids) and (not cuts or cuts[0]):  # goes on from the batch before
                        part = ids[: cuts[0] if cuts else len(ids)]
                        counts[-1] += len(part)
                        crcs[-1] = zlib.crc32(part, crcs[-1])
                    for a, b in zip(cuts, [*cuts[1:], len(ids)]):
                        counts.append(b - a)
                        crcs.append(zlib.crc32(ids[a:b]))
            assert len(counts) == len(names), f"shard {shard}: {len(counts)} documents for {len(names)} names"
            sizes = np.array(counts, np.int64)
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(start + np.cumsum(sizes) - sizes), pa.array(sizes), pa.array(crcs, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # a row per file, not per document
    placed = shards.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return placed.repartition("shard").mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the table's tokens under the shared folder and give what the files hold per document."""
    folder = f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    shards = write_tokens(docs, path, folder, id_col=id_col, text_col=text_col)
    return read_tokens(shards, folder, docs.schema[id_col].dataType.simpleString())
