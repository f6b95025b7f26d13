"""Byte-pair encoding and decoding by an index of pairs.

Texts are normalised and cut into pieces as the vocabulary file says. The pieces of a partition that
aren't known yet are encoded together, batch by batch: all their symbols lie in one array, an index maps
each pair that can be merged to all its positions, and the active ranks are taken in ascending order.
All positions of a rank are merged at once, and the pairs that this makes go to the lists of their own
ranks. A piece of any length takes time linear in its symbols for each rank that it has. What a piece
gives is kept, so each is encoded once a partition (and again where a full table starts anew).

Merging rank by rank is what merging one pair after the other within each piece gives, as long as every
merge comes after those that make its parts; that is checked when the file is read.

Defined results: a null text is an empty one, without ids; a null doc_id stays null; repeated rows give
a row each; an empty table gives none; of extra columns, whatever their names, none is read. The string
of a special token in a text is that token. Texts are encoded whole; of a very long one the pieces are
taken a block at a time.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import arrow, slices
from larder.llm.tokens import vocabulary

#: Code points whose class, case and composition all versions of Unicode agree on; texts with others are cut by the library.
_SETTLED = regex.compile(r"[\x00-ԯ‐-‧‰-⁞₠-₿ぁ-ゖァ-ヿ一-龥가-힣]*+")
#: The word pattern of byte-level files (fixed value).
_BYTE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces of a long text that are held at once.
BLOCK = 1 << 18
NONE = np.iinfo(np.int64).max


def byte_chars() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it is printable, else the next free one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(free)) for b in range(256)]


class Bpe:
    """One vocabulary file: pieces of texts, ids of pieces, tokens of ids."""

    #: Pieces kept at most; a full table starts anew.
    PIECES = 400_000
    _made: dict[str, Bpe] = {}

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self._pieces_of(spec, path)
        model = spec["model"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError("only plain byte-level BPE is known")
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("only special tokens that are found as they stand are known")
        self.split = regex.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._tokens_of(vocab, spec["decoder"])
        end = model.get("end_of_word_suffix") or ""
        chars = byte_chars()
        self.inner, self.last = (np.array([vocab[c + s] for c in chars], np.int64) for s in ("", end))
        # merges: the pair as one number, its rank and what it becomes
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        ids = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], np.int64).reshape(-1, 3)
        self.left, self.right, self.made = ids.T
        key = self.left << 32 | self.right
        self.order = np.argsort(key, kind="stable")
        self.key = key[self.order]
        latest = np.full(max(vocab.values()) + 1, -1, np.int64)
        np.maximum.at(latest, self.made, np.arange(len(ids)))
        if (np.maximum(latest[self.left], latest[self.right]) >= np.arange(len(ids))).any():
            raise ValueError("a merge comes before those that make its parts")
        self.fixed = {s: np.array([i], "<u4").tobytes() for s, i in self.special.items()}
        self.known = dict(self.fixed)

    @classmethod
    def of(cls, path: str) -> Bpe:
        """One for each worker process."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _pieces_of(self, spec: dict, path: str) -> None:
        """Read how texts are normalised and cut."""
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        self.normalizer, self.cutter = whole.normalizer, whole.pre_tokenizer
        normal = spec["normalizer"]
        self.steps = normal["normalizers"] if normal and normal["type"] == "Sequence" else [normal] if normal else []
        pre = spec["pre_tokenizer"]
        parts = pre["pretokenizers"] if pre["type"] == "Sequence" else [pre]
        if [p["type"] for p in parts] == ["Split", "ByteLevel"] and parts[0]["invert"] and parts[0]["behavior"] == "Removed" and not parts[1]["use_regex"] and not parts[1]["add_prefix_space"]:
            pattern = parts[0]["pattern"]["Regex"]
        elif [p["type"] for p in parts] == ["ByteLevel"] and parts[0]["use_regex"] and not parts[0]["add_prefix_space"]:
            pattern = _BYTE_WORDS
        else:
            raise ValueError("this way of cutting texts is not known")
        if any(s["type"] not in ("NFC", "Lowercase", "Replace") for s in self.steps):
            raise ValueError("this normalisation is not known")
        self.words = regex.compile(pattern)
        # a lone blank is left as it is where all white space becomes one
        self.replaced = {p: regex.compile(r"\s\s+|[^\S ]" if (p, s["content"]) == (r"\s+", " ") else p) for s in self.steps if s["type"] == "Replace" for p in [s["pattern"]["Regex"]]}

    def _tokens_of(self, vocab: dict[str, int], decoder: dict | None) -> None:
        """Read what ids stand for: strings joined by blanks, or bytes."""
        tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            tokens[i] = token
        self.as_bytes = decoder is not None
        if decoder is None:
            self.token: list = tokens
            return
        if decoder["type"] != "ByteLevel":
            raise ValueError("this way of decoding is not known")
        byte = {c: bytes([b]) for b, c in enumerate(byte_chars())}
        self.token = [b"".join(map(byte.__getitem__, t)) if all(c in byte for c in t) else t.encode() for t in tokens]

    def normal(self, text: str) -> str:
        for s in self.steps:
            if s["type"] == "NFC":
                text = text if text.isascii() else unicodedata.normalize("NFC", text)
            elif s["type"] == "Lowercase":
                text = text.replace("Σ", "σ").lower()  # letter by letter: no final sigma
            else:
                text = self.replaced[s["pattern"]["Regex"]].sub(s["content"], text)
        return text

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text, in blocks; a special token is a block of its own."""
        parts = self.split.split(text) if self.split and any(s in text for s in self.special) else [text]
        for i, part in enumerate(parts):
            if i % 2:
                yield [part]
            elif not part:
                continue
            elif part.isascii() or _SETTLED.fullmatch(part):
                part = self.normal(part)
                if len(part) < 4 * BLOCK:
                    yield self.words.findall(part)
                    continue
                found = (m[0] for m in self.words.finditer(part))
                while block := list(islice(found, BLOCK)):
                    yield block
            else:
                part = self.normalizer.normalize_str(part) if self.normalizer else part
                spans = [s for _, s in self.cutter.pre_tokenize_str(part)]
                for low in range(0, len(spans), BLOCK):
                    yield [part[s:e] for s, e in spans[low : low + BLOCK]]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; a null is an empty text."""
        out: list[list[bytes]] = []
        waiting: list[tuple[int, list[str]]] = []
        held = 0
        for text in texts:
            out.append([])
            for block in self.pieces(text or ""):
                waiting.append((len(out) - 1, block))
                held += len(block)
                if held > 2 * BLOCK:
                    self._look_up(waiting, out)
                    waiting, held = [], 0
        self._look_up(waiting, out)
        return [b"".join(x) for x in out]

    def _look_up(self, blocks: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        """Append the ids of each block to those of its text; pieces that are new are learnt together."""
        need = set().union(*(b for _, b in blocks)) if blocks else set()
        if len(self.known) + len(need) > self.PIECES:
            self.known = dict(self.fixed)
        new = [p for p in need if p not in self.known]
        if new:
            self.known.update(zip(new, self.merge(new)))
        for row, block in blocks:
            out[row].append(b"".join(map(self.known.__getitem__, block)))

    def merge(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, by the pair index over all of them."""
        raw = [p.encode() for p in pieces]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(size)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbol = self.inner[data]
        symbol[ends - 1] = self.last[data[ends - 1]]
        after, before = np.arange(1, len(data) + 1), np.arange(-1, len(data) - 1)
        after[ends - 1] = -1
        before[ends - size] = -1
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(at: np.ndarray) -> None:
            """Add the pairs that begin at these positions to the lists of their ranks."""
            key = symbol[at] << 32 | symbol[after[at]]
            place = np.searchsorted(self.key, key)
            place[place == len(self.key)] = 0
            rank = np.where(self.key[place] == key, self.order[place], NONE)
            order = np.argsort(rank, kind="stable")
            rank, at = rank[order], at[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rank)]):
                r = int(rank[s])
                if r != NONE:
                    if r not in index:
                        index[r] = []
                        heapq.heappush(active, r)
                    index[r].append(at[s:e])

        if len(self.key):
            first = np.flatnonzero(after >= 0)
            if len(first):
                enter(first)
        while active:
            rank = heapq.heappop(active)
            a, b, made = self.left[rank], self.right[rank], self.made[rank]
            at = np.concatenate(index.pop(rank))
            at = at[symbol[at] == a]
            at = at[after[at] >= 0]
            at = at[symbol[after[at]] == b]
            if a == b and len(at) > 1:
                at.sort()
                # of a run a a a ... the first, third, ... position
                new_run = np.ones(len(at), bool)
                new_run[1:] = after[at[:-1]] != at[1:]
                step = np.arange(len(at))
                at = at[(step - np.maximum.accumulate(np.where(new_run, step, 0))) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            beyond = after[gone]
            symbol[at], symbol[gone], after[at] = made, -1, beyond
            more = beyond >= 0
            before[beyond[more]] = at[more]
            left = before[at]
            left = left[left >= 0]
            touched = np.concatenate((left[symbol[left] != made], at[more]))
            if len(touched):
                enter(touched)
        kept = symbol >= 0
        flat = symbol[kept].astype("<u4").tobytes()
        bounds = np.concatenate(([0], np.cumsum(kept)[ends - 1])).tolist()
        return [flat[4 * s : 4 * e] for s, e in zip(bounds, bounds[1:])]

    def decode(self, ids: bytes) -> str:
        tokens = map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist())
        return b"".join(tokens).decode("utf-8", "replace") if self.as_bytes else " ".join(tokens)


def encode(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): the ids of each whole text as little-endian unsigned 32-bit integers."""
    return _run(docs, tokenizer, doc_id, text, "ids binary", lambda bpe, texts: [bpe.encode(texts)])


def round_trip(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): the ids of each whole text, and the text that these ids decode to."""

    def both(bpe: Bpe, texts: list[str | None]) -> list[list]:
        ids = bpe.encode(texts)
        return [ids, [bpe.decode(x) for x in ids]]

    return _run(docs, tokenizer, doc_id, text, "ids binary, decoded string", both)


def decode(rows: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, decoded): what ids (as :func:`encode` gives them) decode to; null ids are none."""
    return _run(rows, tokenizer, doc_id, ids, "decoded string", lambda bpe, found: [[bpe.decode(x or b"") for x in found]])


def _run(rows: DataFrame, tokenizer: str, doc_id: str, column: str, out: str, step) -> DataFrame:
    narrow = rows.select(F.col(doc_id).alias("doc_id"), F.col(column).alias("content"))
    schema = narrow.select("doc_id").schema
    fields = [f.split(" ") for f in out.split(", ")]
    for name, kind in fields:
        schema = schema.add(name, kind)
    types = [pa.binary() if kind == "binary" else pa.string() for _, kind in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.of(tokenizer)
        for batch in slices(batches, "content"):
            found = step(bpe, batch.column("content").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, t) for x, t in zip(found, types))], ["doc_id", *(n for n, _ in fields)])

    return arrow(narrow, run, schema)


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary("word_bpe_49k.json"))
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
