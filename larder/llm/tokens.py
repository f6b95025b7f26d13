"""Token ids as flat binary files.

``write_tokens`` sorts documents by id over range partitions. Each partition writes three flat
little-endian files: ``.bin`` (unsigned token ids), ``.idx`` (unsigned 64-bit offsets of its
documents within it, one more than documents) and ``.ids`` (signed 64-bit document ids). The
driver sees one row per partition: the prefix sums of their sizes are the partition bases, kept in
``manifest.json``. ``read_tokens`` maps the files and gives global positions: base plus offset.

Defined results: a null or empty text is the end id alone; a null doc_id comes first, is stored as
the smallest 64-bit integer and read as null; repeated ids are ordered by text; an empty table
gives a manifest without parts. Texts are encoded whole.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import SpanHash, arrow, map_file, scratch, slices, store, text_bytes, whole_file

NULL_ID = -(1 << 63)
#: The word pattern (fixed value of the vocabulary file) that drops white space and never crosses it.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


#: White space: the ASCII ones (with the information separators, to be careful) and the others in UTF-8.
_SPACE = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
_WIDE = [int.from_bytes(chr(c).encode(), "big") for c in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of the spans, one span after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


class Encoder:
    """Whole texts to ids, as the tokenizers library gives them, with recurring words encoded once.

    The pre-tokenizers of the two kinds known here never join what a lone blank or line feed between
    two non-blanks parts: byte-level splitting puts the blank at the front of the next word and makes
    the line feed a token, the word pattern drops both. So a text is cut before each of these; a piece
    is looked up by a 64-bit hash, in arrays over a whole batch, and its bytes are compared with those
    of the piece that is found; new pieces are encoded many at once, with a separator between them
    whose id cuts the result. Texts with a piece whose hash belongs to other bytes, texts with the
    string of a special token, and all texts of other tokenizers, are encoded in one.
    """

    #: Pieces kept at most; a full table starts anew.
    PIECES = 1_000_000
    _made: dict[str, Encoder] = {}

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in spec["added_tokens"]]
        pre = spec["pre_tokenizer"] or {}
        first = (pre.get("pretokenizers") or [{}])[0]
        normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [spec["normalizer"]]) if n]
        self.kind, self.mark = "whole", ""
        if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not normal:
            self.kind, self.mark = "blank", "\n"
        elif first.get("type") == "Split" and first["pattern"].get("Regex") == _WORDS and first["invert"] and set(normal) <= {"NFC", "Replace", "Lowercase"}:
            self.kind, self.mark = "drop", " \x01 "
        self.line = np.array(self.ids("\n"), "<u4")
        mark = self.ids(self.mark)
        self.cut = mark[0] if len(mark) == 1 else None
        self.forget()

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One for each worker process, so that pieces are still known in its next task."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def forget(self) -> None:
        self.key = np.zeros(0, np.uint64)
        self.at, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")
        self.raw_at, self.raw_size, self.raw = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)

    def pieces(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of each piece."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        # a piece without white space but at its front, and without the separator
        bare = [p[1:] if p[0] in " \n" else p for p in pieces]
        easy = [i for i, p in enumerate(bare) if self.cut is not None and p and p.isprintable() and " " not in p]
        for low in range(0, len(easy), 2000):
            part = easy[low : low + 2000]
            ids = np.array(self.ids(self.mark.join([bare[i] if pieces[i][0] == "\n" else pieces[i] for i in part])), "<u4")
            cuts = np.flatnonzero(ids == self.cut)
            if len(cuts) == len(part) - 1:
                for i, s, e in zip(part, [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]):
                    out[i] = np.concatenate((self.line, ids[s:e])) if pieces[i][0] == "\n" else ids[s:e]
        return [np.array(self.ids(p), "<u4") if x is None else x for p, x in zip(pieces, out)]

    def encode(self, column: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; a null is an empty text."""
        column = pc.fill_null(column, "")
        whole = np.full(len(column), self.kind == "whole")
        for s in self.special:
            whole |= pc.match_substring(column, s).to_numpy(zero_copy_only=False)
        flat = np.zeros(0, "<u4")
        data, offsets = text_bytes(column)
        bounds = np.zeros(len(column) + 1, np.int64)
        if len(data) and not whole.all():
            starts, sizes, row = self.cuts(data, offsets)
            found, same = self.lookup(data, starts, starts + sizes)
            whole[row[~same]] = True  # another piece has the hash
            where, n = self.at[found], self.size[found]
            flat = self.pool[_spans(where, n)]
            bounds = np.concatenate(([0], np.cumsum(np.bincount(row, n, len(column)).astype(np.int64))))
        out = flat.tobytes()
        return [np.array(self.ids(column[i].as_py()), "<u4").tobytes() if w else out[4 * s : 4 * e] for i, (w, s, e) in enumerate(zip(whole, bounds[:-1].tolist(), bounds[1:].tolist()))]

    @staticmethod
    def cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, size and row of all pieces; a piece begins with a row or with a lone separator."""
        space = _SPACE[data]
        two = np.flatnonzero(data[:-1] == 0xC2)
        two = two[np.isin(data[two + 1], [0x85, 0xA0])]
        three = np.flatnonzero((data[:-2] >= 0xE1) & (data[:-2] <= 0xE3))
        three = three[np.isin((data[three].astype(np.int32) << 16) | (data[three + 1].astype(np.int32) << 8) | data[three + 2], _WIDE)]
        for at, n in ((two, 2), (three, 3)):
            for i in range(n):
                space[at + i] = True
        padded = np.ones(len(data) + 2, bool)
        padded[1:-1] = space
        edge = np.zeros(len(data), bool)
        full = offsets[:-1] < offsets[1:]
        edge[offsets[:-1][full]] = True
        edge[offsets[1:][full] - 1] = True
        lone = ((data == 32) | (data == 10)) & ~padded[:-2] & ~padded[2:] & ~edge
        lone[offsets[:-1][full]] = True
        starts = np.flatnonzero(lone)
        row = np.searchsorted(offsets, starts, side="right") - 1
        return starts, np.append(starts[1:], len(data)) - starts, row

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place in the table of each piece, new ones learnt, and whether the bytes there are its own."""
        key = SpanHash(data).of(starts, ends)
        names, first, back = np.unique(key, return_index=True, return_inverse=True)
        if len(self.key) + len(names) > self.PIECES:
            self.forget()
        at = np.searchsorted(self.key, names)
        known = np.zeros(len(names), bool)
        near = at < len(self.key)
        known[near] = self.key[at[near]] == names[near]
        new = first[~known]
        if len(new):
            raw, size = data.tobytes(), ends[new] - starts[new]
            ids = self.pieces([raw[s:e].decode() for s, e in zip(starts[new].tolist(), ends[new].tolist())])
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            rows = (key[new], len(self.pool) + np.cumsum(n) - n, n, len(self.raw) + np.cumsum(size) - size, size)
            self.pool = np.concatenate((self.pool, *ids))
            self.raw = np.concatenate((self.raw, data[_spans(starts[new], size)]))
            merged = np.concatenate((self.key, key[new]))
            order = np.argsort(merged, kind="stable")
            self.key, self.at, self.size, self.raw_at, self.raw_size = (np.concatenate(x)[order] for x in zip((self.key, self.at, self.size, self.raw_at, self.raw_size), rows))
            at = np.searchsorted(self.key, names)
        found, size = at[back], ends - starts
        same = self.raw_size[found] == size
        # pieces lie one after the other, so the bytes of all are those of the data
        mine, theirs = (data[starts[0] :], self.raw[_spans(self.raw_at[found], size)]) if same.all() else (data[_spans(starts[same], size[same])], self.raw[_spans(self.raw_at[found[same]], size[same])])
        unlike = np.flatnonzero(mine != theirs)
        if len(unlike):
            compared = np.flatnonzero(same)
            same[compared[np.searchsorted(np.cumsum(size[compared]), unlike, side="right")]] = False
        return found, same


def encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[tuple[object, bytes]]:
    """(doc_id, ids with the end id) of each row."""
    encoder, end = Encoder.of(path), np.array([end_id], "<u4").tobytes()
    for batch in slices(batches, "text"):
        for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
            yield doc, ids + end


def write_tokens(docs: DataFrame, out: str, tokenizer: str, *, end_id: int = 2, dtype: str = "<u2", doc_id: str = "doc_id", text: str = "text") -> dict:
    """Write the files below ``out`` and return the manifest. ``dtype`` must hold every id."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    top = np.iinfo(dtype).max

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        name = f"{out}/part-{part:06d}"
        offsets, ids = [0], []
        with whole_file(f"{name}.bin", attempt) as f:
            for doc, tokens in encoded(batches, tokenizer, end_id):
                own = np.frombuffer(tokens, "<u4")
                if own.max() > top:
                    raise ValueError(f"id {own.max()} does not fit {dtype}")
                f.write(own.astype(dtype).tobytes())
                offsets.append(offsets[-1] + len(own))
                ids.append(NULL_ID if doc is None else doc)
        for kind, values in (("idx", np.array(offsets, "<u8")), ("ids", np.array(ids, "<i8"))):
            with whole_file(f"{name}.{kind}", attempt) as f:
                f.write(values.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([offsets[-1]], pa.int64())], ["part", "docs", "tokens"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange(n, F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    sizes = sorted(tuple(r) for r in arrow(ordered, write, "part int, docs long, tokens long").collect())  # a row per partition
    bases = np.concatenate(([0], np.cumsum([t for _, _, t in sizes], dtype=np.int64)))
    manifest = {"dtype": dtype, "end_id": end_id, "parts": [{"part": p, "docs": d, "tokens": t, "base": int(b)} for (p, d, t), b in zip(sizes, bases) if d]}
    with whole_file(f"{out}/manifest.json", 0) as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def read_manifest(out: str) -> dict:
    fs, path = store(f"{out}/manifest.json")
    with fs.open_input_stream(path) as f:
        return json.loads(f.read())


def read_tokens(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids as little-endian unsigned 32-bit integers), read back from the files."""
    manifest = spark.sparkContext.broadcast(read_manifest(out))
    parts = len(manifest.value["parts"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column("id").to_pylist():
                part = manifest.value["parts"][i]
                name = f"{out}/part-{part['part']:06d}"
                tokens = map_file(f"{name}.bin", manifest.value["dtype"])
                offsets, ids = map_file(f"{name}.idx", "<u8").astype(np.int64), map_file(f"{name}.ids", "<i8")
                for low in range(0, len(ids), 1000):
                    own = range(low, min(low + 1000, len(ids)))
                    flat = [tokens[offsets[k] : offsets[k + 1]].astype("<u4").tobytes() for k in own]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([None if ids[k] == NULL_ID else int(ids[k]) for k in own], pa.int64()),
                            pa.array([part["base"] + int(offsets[k]) for k in own], pa.int64()),
                            pa.array([len(x) // 4 for x in flat], pa.int64()),
                            pa.array([zlib.crc32(x) for x in flat], pa.int64()),
                            pa.array(flat, pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                    )

    return arrow(spark.range(0, parts, 1, max(parts, 1)), read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch(spark, "tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), out, vocabulary("byte_bpe_50k.json"))
    return read_tokens(spark, out).drop("ids")
