"""Best-fit packing of token pieces with a bounded number of open sequences."""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import give_back, stored

#: Bytes of words and ids that a task remembers, beside as many from the time before.
KNOWN_BYTES = 40 << 20
#: What a remembered word takes beside its letters and ids.
ENTRY = 140
#: Characters whose unknown words are encoded in one call.
GROUP = 1 << 20
#: Cut off a run of letters before it is looked up.
PUNCTUATION = ".,;:!?*%$&#|"
#: White space, as Unicode has it.
WHITE = "\t\n\v\f\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Words other than runs of letters.
APART = r"'(?:[stmd]|re|ve|ll)|\p{N}|[^ \p{L}\p{N}]+"
#: Bytes of the longest word in a text that is encoded in one call, whose time grows with the square of a word.
LONGEST = 256
#: Bytes of ids in one batch of pieces.
BATCH = 4 << 20
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids binary"
PLACE = "sequence bigint, offset bigint"


def byte_letters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def plain_letters(word: str) -> bool:
    """Whether a word is letters that are lower-cased one by one and stay letters."""
    if word.isascii():
        return word.isalpha()
    return word.isalpha() and max(word) < "\u0530" and "\u03a3" not in word and word.lower().isalpha() and is_normalized("NFC", word)


def regular(ranks: dict[bytes, int], merges: list[tuple[bytes, bytes]], units: int) -> bool:
    """Whether joining neighbours of the lowest rank makes each token by its own merge.

    A tokenizer that joins the pairs in ``merges`` only then does the same as one that
    joins all pairs whose bytes are in ``ranks``. A blank, which ends a word, is one
    unit with the byte before; ``units`` ranks are those of the units.
    """
    for left, right in merges:
        whole = left + right
        parts = [bytes([b]) for b in whole.removesuffix(b" ")]
        if whole.endswith(b" "):
            parts[-1] += b" "
        if len(parts) < 2 or ranks[whole] < units or any(ranks.get(p, units) >= units for p in parts):
            return False
        while True:
            rank, at = min((ranks.get(x + y, ranks[whole]), i) for i, (x, y) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank >= ranks[whole]:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 1:
                return False
        if parts != [left, right]:
            return False
    return True


class EndedWords:
    """Token ids of whole texts by a vocabulary that marks the ends of words.

    For tokenizers of this ``FORM``. With a blank after every word in place of
    the mark, a text is encoded in one call. A text that holds a name of a special
    token, a very long word, or what Unicode's versions or a sigma's place decide is
    left to the tokenizer itself.
    """

    WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    FORM = {
        "normalizer": {
            "type": "Sequence",
            "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
        },
        "pre_tokenizer": {
            "type": "Sequence",
            "pretokenizers": [
                {"type": "Split", "pattern": {"Regex": WORDS}, "behavior": "Removed", "invert": True},
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
            ],
        },
        "model": {
            "type": "BPE",
            "dropout": None,
            "unk_token": None,
            "continuing_subword_prefix": None,
            "end_of_word_suffix": "</w>",
            "fuse_unk": False,
            "byte_fallback": False,
            "ignore_merges": False,
        },
    }

    def __init__(self, ranks: dict[bytes, int], special: list[str]):
        unused = max(ranks.values()) + 1
        # Beside the blank, a name without letters that the search for special tokens looks for.
        self.coder = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks | {b" ": unused}, special_tokens={"\0": unused + 1})
        self.special = special

    @classmethod
    def of(cls, path: str) -> tuple[dict[bytes, int], list[str]] | None:
        """The ranks of byte strings and the special tokens; nothing for a tokenizer of another form."""
        with open(path, encoding="utf-8") as source:
            made = json.load(source)
        model = made["model"]
        form = {k: made[k] for k in ("normalizer", "pre_tokenizer")} | {"model": {k: v for k, v in model.items() if k not in ("vocab", "merges")}}
        if form != cls.FORM or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in made["added_tokens"]):
            return None
        letters, mark = {letter: bytes([b]) for b, letter in byte_letters().items()}, cls.FORM["model"]["end_of_word_suffix"]

        def spelt(token: str) -> bytes:
            core = token.removesuffix(mark)
            return b"".join(letters[c] for c in core) + b" " * (core != token)

        special = [t["content"] for t in made["added_tokens"]]
        if any(not letters.keys() >= set(t.removesuffix(mark)) for t in model["vocab"] if t not in special):
            return None
        merges = [tuple(map(spelt, m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        # No word holds a blank.
        ranks = {spelt(t): i for t, i in model["vocab"].items() if t not in special and b" " not in spelt(t)[:-1] and spelt(t) != b" "}
        order = [ranks.get(x + y, -1) for x, y in merges]
        units = {bytes([b]) + end for b in range(256) if b != 0x20 for end in (b"", b" ")}
        if not units <= ranks.keys() or -1 in order or order != sorted(set(order)) or len(ranks) != len(units) + len(merges):
            return None
        return (ranks, special) if regular(ranks, merges, order[0]) else None

    def lowered(self, text: str) -> str | None:
        """The text as its words are read; nothing if the tokenizer itself has to read it."""
        if any(name in text for name in self.special) or "\u03a3" in text or not is_normalized("NFC", text):
            return None
        for white in WHITE:
            text = text.replace(white, " ")
        return text.lower() if text.isprintable() else None

    def encode(self, lowered: list[str]) -> list[bytes | None]:
        """Ids of lower-cased texts; nothing for one with a very long word."""
        ended = pc.replace_substring_regex(pa.array(lowered, pa.large_string()), pattern=APART, replacement=r" \0 ")
        found = []
        for text in ended:
            text = text.as_py() + " "
            blanks = np.flatnonzero(np.frombuffer(text.encode(), np.uint8) == 0x20)
            if np.diff(blanks, prepend=-1).max() > LONGEST:
                found.append(None)
            else:
                found.append(self.coder.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes())
        return found


ended_words = cache(EndedWords.of)


class WordIds:
    """Token ids of whole texts, as little-endian bytes, word by word.

    For tokenizers that never join what ASCII white space parts: the ids of a
    text are those of its words, one after another. Words seen before are looked
    up. If the tokenizer lower-cases and cuts between letters and punctuation,
    a new word of letters goes straight to its merges, without the punctuation
    that ends it; all other words, and all words of other tokenizers, are encoded
    in full. Texts that ``whole`` can read are encoded by it instead.
    """

    LETTERWISE = (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"], "BPE")

    def __init__(self, path: str, whole: EndedWords | None = None):
        self.path, self.whole, self.tokenizer = path, whole, None
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.learned = 0  # letters of the words in ``known``

    def _load(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(self.path)
        made = json.loads(self.tokenizer.to_str())
        steps = [[s["type"] for s in ((made[k] or {}).get(of) or [])] for k, of in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        self.letterwise = (*steps, made["model"]["type"]) == self.LETTERWISE
        self.model, self.letters = self.tokenizer.model, byte_letters()

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        for group in _groups(texts):
            lowered = [self.whole.lowered(text) for text in group] if self.whole else [None] * len(group)
            done = iter(self.whole.encode([text for text in lowered if text is not None]) if self.whole else [])
            found = [None if text is None else next(done) for text in lowered]
            rest = self._by_words([text for text, ids in zip(group, found, strict=True) if ids is None])
            for ids in found:
                yield next(rest) if ids is None else ids

    def _by_words(self, group: list[str]) -> Iterator[bytes]:
        if group:
            # A token has a letter at least, so ids take four bytes a letter at most.
            if ENTRY * len(self.known) + 5 * self.learned > KNOWN_BYTES:
                self.known, self.before, self.learned = {}, self.known, 0
            rows, new = [], set()
            for text in group:
                words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
                ids = list(map(self.known.get, words))
                gaps = [(i, words[i]) for i, known in enumerate(ids) if known is None]
                new.update(word for _, word in gaps)
                rows.append((ids, gaps))
            if new:
                self._learn(new)
            for ids, gaps in rows:
                for i, word in gaps:
                    ids[i] = self.known[word]
                yield b"".join(ids)

    def forget(self) -> None:
        """Give the memory of the words back; the tokenizer stays."""
        self.known, self.before, self.learned = {}, {}, 0

    def _learn(self, words: set[str]) -> None:
        if not self.tokenizer:
            self._load()
        known, before, whole, ended = self.known, self.before, set(), []
        self.learned += sum(map(len, words))
        for word in words:
            if word in before:
                known[word] = before[word]
                continue
            core = word.rstrip(PUNCTUATION) if self.letterwise else ""
            if not core or not plain_letters(core):
                whole.add(word)
                continue
            if core not in known:
                known[core] = self._merged(core)
            if len(core) < len(word):
                ended.append((word, core))
                whole.add(word[len(core) :])
        new = [w for w in whole if w not in known]
        found = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        known.update((w, array("I", e.ids).tobytes()) for w, e in zip(new, found, strict=True))
        known.update((w, known[core] + known[w[len(core) :]]) for w, core in ended)

    def _merged(self, word: str) -> bytes:
        word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()


def _groups(texts: Iterable[str]) -> Iterator[list[str]]:
    """Texts in groups of about ``GROUP`` characters; a longer text is alone."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > GROUP:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


_encoders: dict[str, WordIds] = {}


def encoder(path: str, vocabulary: tuple[dict[bytes, int], list[str]] | None = None) -> WordIds:
    """One per worker process; the tokenizer is kept from task to task, the words are not."""
    if path not in _encoders:
        _encoders[path] = WordIds(path, EndedWords(*vocabulary) if vocabulary else None)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int = 0) -> DataFrame:
    """Every document's ids and ``end_id``, cut into pieces of at most ``size``."""
    vocabulary = ended_words(tokenizer)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, end = encoder(tokenizer, vocabulary), array("I", [end_id]).tobytes()
        try:
            for batch in batches:
                rows, held = [], 0
                texts = (value.as_py() or "" for value in batch.column("text"))
                for doc, ids in zip(batch.column("doc_id").to_pylist(), ids_of.encode(texts), strict=True):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids), size * 4)):
                        part = ids[start : start + size * 4]
                        rows.append((doc, piece, start // 4, len(part) // 4, part))
                        held += len(part)
                        if held >= BATCH:
                            yield _batch(rows, PIECES)
                            rows, held = [], 0
                yield _batch(rows, PIECES)
        finally:
            # The worker goes on to other tasks and stages.
            ids_of.forget()
            give_back()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(",")]
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields]
    )


class OpenSequences:
    """At most ``bound`` open sequences, in a bitset keyed by free space.

    Bit ``f`` is set while a sequence with ``f`` places left is open. A piece
    goes where least is left over; if nothing has room, a new sequence opens,
    and if that is one too many, the fullest open one closes first.
    """

    def __init__(self, size: int, bound: int):
        self.size, self.bound = size, bound
        self.bits, self.open, self.opened = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]

    def _take(self, free: int) -> int:
        sequence = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        """Sequence and offset of a piece."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            if self.open == self.bound:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, sequence = self.size, self.opened
            self.opened += 1
        if free > length:
            self.by_free[free - length].append(sequence)
            self.bits |= 1 << (free - length)
            self.open += 1
        return sequence, self.size - free


def pack(
    docs: DataFrame,
    tokenizer: str,
    size: int = 2048,
    end_id: int = 0,
    open_sequences: int = 4096,
    task_sequences: int = 16384,
) -> DataFrame:
    """Pieces of all documents with their place in sequences of ``size`` tokens.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids``;
    ``ids`` are the piece's token ids as little-endian 32-bit numbers, so the
    pieces of a ``sequence_id`` by ``offset`` are the packed sequence. A null or empty text is its end token alone. Repeated rows and rows without an
    id are packed like any other; an empty table gives an empty table. Only
    documents longer than ``size`` are cut.

    Texts are tokenized once; the pieces are stored and shuffled with their ids. A
    task packs some ``task_sequences`` sequences, pieces in hashed order, and holds
    ``open_sequences`` open, whatever the size of the table, so all but a few
    sequences of a task are full. Numbers are unique over tasks, not dense.
    """
    cut = stored(pieces(docs, tokenizer, size, end_id), "pieces")
    tokens = cut.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, round(tokens / (size * task_sequences)))
    order = ["hash", *[f.split()[0] for f in PIECES.split(", ")]]
    dealt = cut.withColumn("hash", F.xxhash64("doc_id", "piece")).repartition(tasks)
    dealt = dealt.sortWithinPartitions(*order)

    # Only the lengths go through Python; the ids wait beside them in the rows.
    @F.arrow_udf(PLACE)
    def place(lengths: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bins = OpenSequences(size, open_sequences)
        for batch in lengths:
            places = [bins.place(n) for n in batch.to_pylist()]
            columns = [pa.array([p[i] for p in places], pa.int64()) for i in range(2)]
            yield pa.StructArray.from_arrays(columns, ["sequence", "offset"])

    placed = dealt.withColumn("place", place.asNondeterministic()("length"))
    base = F.shiftleft(F.spark_partition_id().cast("bigint"), 40)
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        (base + F.col("place.sequence")).alias("sequence_id"),
        F.col("place.offset").alias("offset"),
        "ids",
    )
