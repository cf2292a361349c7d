"""Alignment of two tokenizers' tokens over the same bytes, and how often ids meet."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as piece_models

from tributary.llm.common import run_bounds, stored, whole_groups
from tributary.llm.packing import LONGEST, byte_letters

#: Links of several groups that are listed at once; the ids of a larger group are counted first.
LINKS = 1 << 20
#: Distinct links of documents that are held until their block is closed.
BLOCK_LINKS = 4 << 20
#: Ends that are compared first where a stretch may begin.
PROBE = 8
#: What marks the start of a word in a piece.
BLANK = "▁"


def _unused(number: int) -> dict[str, int]:
    """A special token, never allowed: the search for none would stop at every letter of a text."""
    return {"<|unused|>": number}


class BytePairs:
    """Ids and bytes by a byte-level vocabulary, special tokens' names being plain text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            model = json.load(source)
        cutter, vocabulary = model["pre_tokenizer"], model["model"]["vocab"]
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["model"]["merges"]]
        ranks = [vocabulary[m] for m in merged]
        if model["normalizer"] or cutter["type"] != "ByteLevel" or cutter["add_prefix_space"] or ranks != sorted(ranks):
            raise ValueError(f"not a plain byte-level vocabulary: {path}")
        letters = {letter: byte for byte, letter in byte_letters().items()}
        special = {t["content"] for t in model["added_tokens"]}
        known = {bytes(letters[c] for c in token): i for token, i in vocabulary.items() if token not in special}
        # Merges in the order of their ids: the id is the rank.
        self.tokens = [b""] * (1 + max(known.values()))
        self.coder = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens=_unused(len(self.tokens)))
        for token, i in known.items():
            self.tokens[i] = token
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)

    def encode(self, text: str) -> np.ndarray:
        return self.coder.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64)

    def bytes_of(self, ids: np.ndarray) -> bytes:
        return self.coder.decode_bytes(ids.tolist())


class Pieces:
    """Ids and bytes by a piece model, which puts the blank before the text itself.

    If the model joins the pieces of the best score, wherever they stand, a text
    without doubled blanks and very long words is encoded by the bytes of its
    pieces; all other texts are left to the model.
    """

    def __init__(self, path: str):
        self.coder = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = []
        for i in range(self.coder.get_piece_size()):
            piece = self.coder.id_to_piece(i)
            byte = bytes([int(piece[3:5], 16)]) if self.coder.is_byte(i) else b""
            self.tokens.append(byte or piece.replace(BLANK, " ").encode())
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.joined, self.ids = self._by_bytes(piece_models.ModelProto.FromString(self.coder.serialized_model_proto())) or (None, None)

    def _by_bytes(self, model: piece_models.ModelProto) -> tuple[tiktoken.Encoding, np.ndarray] | None:
        """A byte-level vocabulary and the id of each rank, -1 for parts of letters; nothing for a model of another kind."""
        trained, read, piece = model.trainer_spec, model.normalizer_spec, model.SentencePiece
        normal = {p.piece: i for i, p in enumerate(model.pieces) if p.type == piece.NORMAL}
        bytewise = {self.tokens[i]: i for i, p in enumerate(model.pieces) if p.type == piece.BYTE}
        # Without doubled blanks no other piece of several letters can be met.
        longer = sorted((-model.pieces[i].score, i, p) for p, i in normal.items() if len(p) > 1 and BLANK not in p[1:])
        plain = trained.model_type == trained.BPE and trained.byte_fallback and not trained.treat_whitespace_as_suffix
        plain &= read.add_dummy_prefix and read.escape_whitespaces and not read.remove_extra_whitespaces and not read.precompiled_charsmap
        plain &= all(p.type in (piece.NORMAL, piece.BYTE, piece.CONTROL, piece.UNKNOWN) for p in model.pieces)
        plain &= len(bytewise) == 256 and BLANK in normal and not any(BLANK in p.lstrip(BLANK) for p in normal)
        if not plain or len({score for score, _, _ in longer}) < len(longer):
            return None
        # Bytes first, then what makes letters of them, then the joined pieces by score.
        letters = {p.replace(BLANK, " ").encode(): i for p, i in normal.items() if len(p) == 1}
        found = {byte: letters.get(byte, i) for byte, i in sorted(bytewise.items())}
        found |= {part: -1 for size in (2, 3) for part in sorted({letter[:size] for letter in letters if len(letter) > size})}
        found |= {letter: i for letter, i in letters.items() if len(letter) > 1}
        found |= {self.tokens[i]: i for _, i, _ in longer}
        # A word that is a piece is not joined but looked up.
        words = [(i, p[1:]) for _, i, p in longer if p[0] == BLANK]
        if self.coder.encode([w for _, w in words], num_threads=1) != [[i] for i, _ in words]:
            return None
        ranks = {token: rank for rank, token in enumerate(found)}
        coder = tiktoken.Encoding("pieces", pat_str=" [^ ]+", mergeable_ranks=ranks, special_tokens=_unused(len(ranks)))
        return coder, np.array(list(found.values()), np.int64)

    def encode(self, text: str) -> np.ndarray:
        if self.joined and BLANK not in text:
            raw = np.frombuffer((" " + text).encode(), np.uint8)
            sizes = np.diff(np.flatnonzero(raw == 0x20), append=len(raw))
            if sizes.min() > 1 and sizes.max() <= LONGEST:
                ids = self.ids[self.joined.encode_to_numpy(" " + text, disallowed_special=())]
                if ids.min() >= 0:
                    return ids
        return np.array(self.coder.encode(text, num_threads=1), np.int64)

    def bytes_of(self, ids: np.ndarray) -> bytes:
        return b"".join([self.tokens[i] for i in ids.tolist()])


def boundaries(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of either side up to every byte offset where tokens of both end.

    Along a diagonal, where one token stands against one, the arrays of ends are
    equal at the same shift: pieces of doubled length are compared until they
    differ, the last one is halved to the place, and the stretch is skipped in
    one step. An irregular group is resolved token by token, which sets the next
    shift. Both sides end at the same byte.
    """
    a, b = a_ends.tolist(), b_ends.tolist()
    # Pieces of bytes are compared in one go; an end takes ``width`` of them.
    kind = np.int32 if not a or a[-1] < 1 << 31 else np.int64
    width, one, other = np.dtype(kind).itemsize, a_ends.astype(kind).tobytes(), b_ends.astype(kind).tobytes()
    i = j = 0
    most = len(a)
    a_first, b_first, lengths = [], [], []  # boundaries follow one another in steps of one
    while i < most:
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        i += 1
        j += 1
        a_first.append(i)
        b_first.append(j)
        p, q, size = i * width, j * width, PROBE * width
        while p < len(one) and (piece := one[p : p + size]) == other[q : q + size]:
            p += len(piece)
            q += len(piece)
            size *= 2
        while size > width:
            size //= 2
            if (piece := one[p : p + size]) == other[q : q + size]:
                p += len(piece)
                q += len(piece)
        lengths.append(p // width - i + 1)
        i, j = p // width, q // width
    many = np.array(lengths, np.int64)
    step = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(np.array(a_first, np.int64), many) + step, np.repeat(np.array(b_first, np.int64), many) + step


@dataclass
class Aligned:
    """Ids of both sides, and the numbers of tokens up to the end of each group."""

    a: np.ndarray
    b: np.ndarray
    a_cuts: np.ndarray
    b_cuts: np.ndarray

    def links(self, base: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct ``a * base + b`` of tokens that share a group, and how often each."""
        a_starts, b_starts = np.append(0, self.a_cuts[:-1]), np.append(0, self.b_cuts[:-1])
        across = self.b_cuts - b_starts
        many = (self.a_cuts - a_starts) * across
        large = np.flatnonzero(many > LINKS)
        found = [self._group(a_starts[g], self.a_cuts[g], b_starts[g], self.b_cuts[g], base) for g in large.tolist()]
        small = np.flatnonzero(many <= LINKS)
        upto = np.cumsum(many[small])
        for groups in np.split(small, np.flatnonzero(np.diff(upto // LINKS)) + 1):
            of = np.repeat(groups, many[groups])
            within = np.arange(len(of)) - np.repeat(np.cumsum(many[groups]) - many[groups], many[groups])
            down, right = np.divmod(within, across[of])
            pairs, times = np.unique(self.a[a_starts[of] + down] * base + self.b[b_starts[of] + right], return_counts=True)
            found.append((pairs, times))
        if len(found) == 1:
            return found[0]
        return summed(*(np.concatenate(c) for c in zip(*found, strict=True)))

    def _group(self, a_first: int, a_last: int, b_first: int, b_last: int, base: int) -> tuple[np.ndarray, np.ndarray]:
        """The same of one group of many tokens, by its distinct ids."""
        a, a_times = np.unique(self.a[a_first:a_last], return_counts=True)
        b, b_times = np.unique(self.b[b_first:b_last], return_counts=True)
        return (a[:, None] * base + b).ravel(), (a_times[:, None] * b_times).ravel()


def summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, their numbers added."""
    order = np.argsort(keys, kind="stable")
    first, _ = run_bounds(keys[order])
    return keys[order][first], np.add.reduceat(times[order], first) if len(first) else times


class Aligner:
    """Both tokenizers of a task."""

    def __init__(self, a: str, b: str):
        self.a, self.b = BytePairs(a), Pieces(b)
        numbers = range(max(len(self.a.tokens), len(self.b.tokens)))
        self.shown = [np.array([f"{i}{mark}" for i in numbers], object) for mark in ",|;"]

    def align(self, text: str | None) -> Aligned | None:
        """Nothing for a null or empty text, and for one that either side does not give back byte by byte."""
        if not text:
            return None
        a, b = self.a.encode(text), self.b.encode(text)
        raw = (" " + text).encode()
        if self.a.bytes_of(a) != raw or self.b.bytes_of(b) != raw:
            return None
        cuts = boundaries(np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b]))
        return Aligned(a, b, *cuts)

    def written(self, found: Aligned) -> str:
        """``a1,a2|b1;a3|b2,b3``: the groups in order, ids in decimal."""
        out = np.empty(len(found.a) + len(found.b), object)
        a_many, b_many = np.diff(found.a_cuts, prepend=0), np.diff(found.b_cuts, prepend=0)
        commas, bars, ends = self.shown
        for ids, cuts, shift, last in (
            (found.a, found.a_cuts, np.repeat(found.b_cuts - b_many, a_many), bars),
            (found.b, found.b_cuts, np.repeat(found.a_cuts, b_many), ends),
        ):
            shown = commas[ids]
            shown[cuts - 1] = last[ids[cuts - 1]]
            out[np.arange(len(ids)) + shift] = shown
        return "".join(out.tolist())[:-1]


def _text_rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def align(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Tokens of both sides and their groups: ``doc_id, a_ids, b_ids, a_cuts, b_cuts``.

    ``a_cuts[g]`` and ``b_cuts[g]`` are the tokens up to the end of group ``g``. All
    four are empty where ``link_counts`` has no tokens. Repeated rows give repeated
    rows, an empty table none; other columns are not read.
    """
    names = ["a_ids", "b_ids", "a_cuts", "b_cuts"]

    def aligned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a, b)
        for batch in batches:
            for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                found = aligner.align(text.as_py())
                lists = [found.a, found.b, found.a_cuts, found.b_cuts] if found else [np.zeros(0, np.int64)] * 4
                columns = [pa.array([doc.as_py()], pa.int64()), *(pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in lists)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *names])

    return _text_rows(docs).mapInArrow(aligned, "doc_id bigint, " + ", ".join(f"{n} array<int>" for n in names))


COUNTS = ("n_a", "n_b", "n_groups", "n_links")
BLOCKS = "block bigint, kind tinyint, pair bigint, docs bigint, doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
BLOCKS += ", groups_sha256 string, links binary"
TYPES = {"bigint": pa.int64(), "tinyint": pa.int8(), "string": pa.string(), "binary": pa.binary()}


def _blocks(rows: int, **columns) -> pa.RecordBatch:
    """Rows of ``BLOCKS``; what is not given is null."""
    fields = [f.split() for f in BLOCKS.split(", ")]
    arrays = [pa.array(columns[n], TYPES[kind]) if n in columns else pa.nulls(rows, TYPES[kind]) for n, kind in fields]
    return pa.RecordBatch.from_arrays(arrays, [n for n, _ in fields])


def _packed(places: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending places and their times; the small differences compress well."""
    numbers = np.concatenate([np.diff(places, prepend=0), times]).astype("<i4").tobytes()
    return pa.compress(numbers, codec="zstd", asbytes=True) if numbers else b""


def _unpacked(packed: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(pa.decompress(packed, decompressed_size=8 * size, codec="zstd", asbytes=True), "<i4") if size else np.zeros(0, np.int32)
    return np.cumsum(numbers[:size]), numbers[size:].astype(np.int64)


class Block:
    """Documents whose links are numbered together."""

    def __init__(self, number: int):
        self.number, self.docs, self.links, self.size = number, [], [], 0

    def add(self, doc: tuple, links: tuple[np.ndarray, np.ndarray]) -> None:
        self.docs.append(doc)
        self.links.append((links[0], links[1].astype(np.int32)))
        self.size += len(links[0]) + 64

    def rows(self) -> Iterator[pa.RecordBatch]:
        """One row per distinct link with its documents, and the documents with places among these."""
        every = np.concatenate([pairs for pairs, _ in self.links])
        distinct, docs = np.unique(every, return_counts=True)
        for some in range(0, len(distinct), 1 << 17):
            pairs = distinct[some : some + (1 << 17)]
            n = len(pairs)
            yield _blocks(n, block=np.full(n, self.number), kind=np.zeros(n, np.int8), pair=pairs, docs=docs[some : some + n])
        for some in range(0, len(self.docs), 1024):
            docs, links = self.docs[some : some + 1024], self.links[some : some + 1024]
            columns = dict(zip(("doc_id", *COUNTS, "groups_sha256"), zip(*docs, strict=True), strict=True))
            columns["links"] = [_packed(np.searchsorted(distinct, pairs), times) for pairs, times in links]
            columns["pair"] = [len(pairs) for pairs, _ in links]
            n = len(docs)
            yield _blocks(n, block=np.full(n, self.number), kind=np.ones(n, np.int8), **columns)


def link_counts(docs: DataFrame, a: str, b: str) -> DataFrame:
    """Groups and links of every row of ``docs``, and how common its links are.

    ``a`` is a byte-level vocabulary, which reads a blank and the text, ``b`` a piece
    model, which adds the blank. Byte offsets where tokens of both end part the
    tokens into groups; a link is a pair of tokens of both sides in one group. The
    count of a pair of ids is the number of rows that hold it linked. Returns
    ``doc_id, n_a, n_b, n_groups, n_links, n_best`` (links whose count is the
    highest of their id of ``a``), ``count_sum`` (of the links' counts) and
    ``groups_sha256``. Null and empty texts, and texts that either side does not
    give back byte by byte, have no tokens: zeros and an empty digest. Repeated
    rows count each; an empty table gives an empty table; other columns are not read.

    Texts are encoded once. A task numbers the links of a block of documents,
    so that what is shuffled is one row per block and distinct pair, however
    often a pair occurs; documents wait in their blocks for the counts.
    """

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a, b)
        base = len(aligner.b.tokens)
        nothing = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        number = TaskContext.get().partitionId() << 32
        block = Block(number)
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = aligner.align(text.as_py())
                if found is None:
                    block.add((doc, 0, 0, 0, 0, ""), nothing)
                else:
                    links = found.links(base)
                    digest = hashlib.sha256(aligner.written(found).encode()).hexdigest()
                    block.add((doc, len(found.a), len(found.b), len(found.a_cuts), int(links[1].sum()), digest), links)
                if block.size >= BLOCK_LINKS:
                    yield from block.rows()
                    number += 1
                    block = Block(number)
        if block.docs:
            yield from block.rows()

    rows = stored(_text_rows(docs).mapInArrow(blocks, BLOCKS), "blocks")
    pairs = rows.where("kind = 0").select("block", "pair", "docs")
    # A pair has one row per block at the most.
    counted = pairs.select("block", "pair", F.sum("docs").over(Window.partitionBy("pair")).alias("docs"))
    counted = stored(counted, "pairs")
    base = Pieces(b).coder.get_piece_size()
    first = F.floor(F.col("pair") / base)
    # At most one row per id of the vocabulary.
    best = F.broadcast(counted.groupBy(first.alias("first")).agg(F.max("docs").alias("most")))
    known = counted.join(best, first == F.col("first")).select("block", F.lit(0).cast("tinyint").alias("kind"), "pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
    waiting = rows.where("kind = 1").drop("docs")
    both = known.unionByName(waiting, allowMissingColumns=True)
    names = ["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"]
    schema = ", ".join(f"{n} {'string' if n == 'groups_sha256' else 'bigint'}" for n in names)

    def looked_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, "block"):
            for start, end in zip(*run_bounds(batch.column("block").to_numpy()), strict=True):
                block = batch.slice(start, end - start)
                kinds = block.column("kind").to_numpy()
                at = int(np.searchsorted(kinds, 1))
                docs = block.column("docs").slice(0, at).to_numpy(zero_copy_only=False).astype(np.int64)
                best = block.column("best").slice(0, at).to_numpy(zero_copy_only=False).astype(bool)
                own = block.slice(at)
                n_best, count_sum = [], []
                for packed, size in zip(own.column("links"), own.column("pair").to_pylist(), strict=True):
                    places, times = _unpacked(packed.as_py(), size)
                    n_best.append(int(times[best[places]].sum()))
                    count_sum.append(int((times * docs[places]).sum()))
                found = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
                yield pa.RecordBatch.from_arrays([found[n] if n in found else own.column(n) for n in names], names)

    return both.repartition("block").sortWithinPartitions("block", "kind", "pair").mapInArrow(looked_up, schema)
