"""Alignment of tokenizers, quality vectors and collocations against plain versions."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tributary.llm import alignment, automata, collocations, quality
from tributary.llm.automata import Automaton

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
#: Columns whose names clash with what the operators return or use inside.
EXTRA = ("source", "score", "predicted", "held_out", "block", "pair", "kind", "docs", "range", "words", "rank", "phrase", "a", "n", "total")


def with_clashes(frame):
    for name in EXTRA:
        frame = frame.withColumn(name, F.lit("x"))
    return frame


def as_rows(frame):
    return Counter(tuple(map(str, r)) for r in frame.collect())


# --- 11: alignment


def plain_alignment(rows):
    """The contract, group by group and link by link, with the other library for A."""
    coder, pieces = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    coder.encode_special_tokens = True
    shown = {i: t for t, i in coder.get_vocab().items()}
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printed)))}

    def piece_bytes(i):
        piece = pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()

    found, linked = [], Counter()
    for doc, text in rows:
        groups = []
        if text:
            a, b = coder.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
            sides = [[bytes(byte_of[c] for c in shown[i]) for i in a], [piece_bytes(i) for i in b]]
            if all(b"".join(side) == (" " + text).encode() for side in sides):
                ends = [np.cumsum([len(t) for t in side]).tolist() for side in sides]
                start = [0, 0]
                for end in sorted(set(ends[0]) & set(ends[1])):
                    stop = [e.index(end) + 1 for e in ends]
                    groups.append((a[start[0] : stop[0]], b[start[1] : stop[1]]))
                    start = stop
        linked.update({(x, y) for one, other in groups for x in one for y in other})
        found.append((doc, groups))
    best = defaultdict(int)
    for (x, _), n in linked.items():
        best[x] = max(best[x], n)
    for doc, groups in found:
        links = [(x, y) for one, other in groups for x in one for y in other]
        text = ";".join(",".join(map(str, one)) + "|" + ",".join(map(str, other)) for one, other in groups)
        yield (
            doc,
            sum(len(one) for one, _ in groups),
            sum(len(other) for _, other in groups),
            len(groups),
            len(links),
            sum(linked[x] == best[x[0]] for x in links),
            sum(linked[x] for x in links),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        )


TEXTS = [
    None, "", "a", " ", "  \n\n\t x", "▁", "a▁b", "<s> </s> <unk> <|endoftext|> <0x41>", "é̂ Ñ 日本語 🙂🙃 \x00 \x01\x7f", "ab" * 4000,
    "=-" * 2000, "\n" * 500, " " * 700, "don't we'll 123456 12 3.14", "The same again", "The same again", "Straße é ﬁ Ⅷ ½",
]


def test_alignment_against_plain(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [*enumerate(TEXTS, 10_000), *map(tuple, given), (None, "no id"), (7, "an id again")]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id bigint, text string")).repartition(3)
    found = alignment.link_counts(docs, A, B)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert as_rows(found) == Counter(tuple(map(str, r)) for r in plain_alignment(rows))
    assert alignment.link_counts(docs.limit(0), A, B).count() == 0


def test_blocks_of_any_size_count_the_same(spark, monkeypatch):
    """A block is numbered by itself; pairs meet across blocks."""
    block = alignment.Block(3)
    for doc, links in ((1, ([5, 9], [1, 2])), (2, ([9], [4])), (3, ([], []))):
        block.add((doc, 0, 0, 0, 0, ""), tuple(np.array(x, np.int64) for x in links))
    pairs, docs = list(block.rows())
    assert pairs.column("pair").to_pylist() == [5, 9] and pairs.column("docs").to_pylist() == [1, 2]
    packed = zip(docs.column("links").to_pylist(), docs.column("pair").to_pylist(), strict=True)
    assert [[x.tolist() for x in alignment._unpacked(p, n)] for p, n in packed] == [[[0, 1], [1, 2]], [[1], [4]], [[], []]]


@pytest.mark.parametrize("seed", range(30))
def test_boundaries_of_any_two_cuts(seed):
    rnd = random.Random(seed)
    size = rnd.choice([1, 2, 5, 40, 400])
    sides = [sorted({*rnd.sample(range(1, size + 1), rnd.randint(0, size)), size}) for _ in range(2)]
    if seed % 3 == 0:  # long stretches of one to one
        sides[1] = sorted({*sides[0], *rnd.sample(sides[0], 1)} - set(rnd.sample(sides[0][:-1], min(2, len(sides[0]) - 1))))
    common = sorted(set(sides[0]) & set(sides[1]))
    cuts = alignment.boundaries(*map(np.array, sides))
    assert [c.tolist() for c in cuts] == [[side.index(e) + 1 for e in common] for side in sides]


def test_links_of_a_large_group_are_counted_not_listed(monkeypatch):
    rnd = np.random.default_rng(0)
    a, b = rnd.integers(0, 5, 300), rnd.integers(0, 7, 200)
    cuts = (np.array([1, 290, 300]), np.array([1, 190, 200]))
    wanted = Counter()
    for (x0, x1), (y0, y1) in zip([(0, 1), (1, 290), (290, 300)], [(0, 1), (1, 190), (190, 200)], strict=True):
        wanted.update((int(p), int(q)) for p in a[x0:x1] for q in b[y0:y1])
    for most in (10, 1000, 1 << 20):
        monkeypatch.setattr(alignment, "LINKS", most)
        pairs, times = alignment.Aligned(a, b, *cuts).links(7)
        assert dict(zip(pairs.tolist(), times.tolist(), strict=True)) == {p * 7 + q: n for (p, q), n in wanted.items()}


def test_other_vocabularies_are_refused(tmp_path):
    model = json.load(open(A, encoding="utf-8"))
    model["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "other.json").write_text(json.dumps(model))
    with pytest.raises(ValueError, match="byte-level"):
        alignment.BytePairs(str(tmp_path / "other.json"))


def test_pieces_by_bytes_are_the_models():
    rnd = random.Random(33)
    parts = ["a", "B", "'s", "’", "“", "é", "e\u0301", "Ж", "中", "か", "²", " ", " ", " ", " the", " of", "  ", "\n", "\r\n", "\t", "\x00", "\xa0", "\ufeff", "!", "42", "😀", "<|endoftext|>"]
    parts += ["<|unused|>", "<s>", "<unk>", "<0x41>", "▁", "hello", "Don't", "가", "執", "—", "\U0010ffff", " " + "a" * 200, "=" * 300]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    pieces = alignment.Pieces(B)
    asked = []
    model = pieces.coder
    wanted = model.encode(texts)

    class Model:
        def encode(self, text, **how):
            asked.append(text)
            return model.encode(text, **how)

    pieces.coder = Model()
    assert [pieces.encode(t).tolist() for t in texts] == wanted
    assert 500 < len(asked) < 2500
    asked.clear()
    plain = "The — “Größe” of it,\nof Жизнь 7 ways."
    assert pieces.encode(plain).tolist() == model.encode(plain) and not asked


def test_models_that_join_otherwise_are_asked_themselves():
    pieces = alignment.Pieces(B)
    changes = [("trainer_spec", "model_type", 1), ("normalizer_spec", "remove_extra_whitespaces", True), ("normalizer_spec", "precompiled_charsmap", b"x")]
    for spec, field, value in changes:
        model = alignment.piece_models.ModelProto.FromString(pieces.coder.serialized_model_proto())
        setattr(getattr(model, spec), field, value)
        assert pieces._by_bytes(model) is None
    model = alignment.piece_models.ModelProto.FromString(pieces.coder.serialized_model_proto())
    model.pieces[300].piece = "a▁b"
    assert pieces._by_bytes(model) is None


def test_unused_special_token_is_plain_text():
    coder = alignment.BytePairs(A)
    for text in ("x<|unused|> y", "<|endoftext|>", "a\n\nb"):
        ids = coder.encode(text)
        assert coder.bytes_of(ids) == (" " + text).encode() and max(ids) < len(coder.tokens)


def test_align_returns_tokens_and_groups(spark):
    docs = spark.createDataFrame([(1, "don't we"), (2, None)], "doc_id bigint, text string")
    one, none = sorted(alignment.align(docs, A, B).collect())
    coder = Tokenizer.from_file(A)
    assert coder.decode(one.a_ids) == " don't we" and one.a_cuts[-1] == len(one.a_ids) and one.b_cuts[-1] == len(one.b_ids)
    assert none.a_ids == none.b_ids == none.a_cuts == none.b_cuts == []


# --- 12: quality


def plain_features(text):
    """Words, pairs of equal words, and n-grams inside blanks, each with its bucket by the same hash."""
    words = (text or "").split()
    mask = (1 << 64) - 1
    mix = int(quality.MIX)

    def bucket(value):
        value = (value ^ value >> 32) * mix & mask
        return (value ^ value >> 32) * mix % (1 << 64) >> 48

    found = [bucket(zlib.crc32(w.encode()) + (1 << 32)) for w in words]
    found += [bucket(2 << 32) for x, y in zip(words, words[1:], strict=False) if x == y]
    for size in quality.GRAMS:
        for word in words:
            points = [32, *map(ord, word), 32]
            for i in range(len(points) - size + 1):
                value = points[i]
                for c in points[i + 1 : i + size]:
                    value = (value * mix + c) & mask
                found.append(bucket(value + size & mask))
    return Counter(found)


@pytest.mark.parametrize("text", [None, "", " \n", "a", "a a a b", "Größe 日本語 x🙂y", "one two  two\nthree " * 9])
def test_features_against_plain(text, monkeypatch):
    for piece in (1, 3, 1 << 15):
        monkeypatch.setattr(quality, "PIECE", piece)
        buckets, counts = quality.counted(text)
        assert dict(zip(buckets.tolist(), counts.tolist(), strict=True)) == plain_features(text)


def test_score_is_the_softmax_of_the_average():
    rnd = np.random.default_rng(3)
    model = quality.Embeddings(rnd.normal(size=(quality.BUCKETS, 4)).astype(np.float32), rnd.normal(size=(2, 4)), rnd.normal(size=2))
    for text in ("", None, "good words here here", "x" * 5000 + " y"):
        counts = plain_features(text)
        mean = sum((model.vectors[b].astype(float) * n for b, n in counts.items()), np.zeros(4)) / max(1, sum(counts.values()))
        raised = np.exp(model.output @ mean + model.bias)
        assert model.score(text) == pytest.approx(raised[1] / raised.sum(), abs=1e-6)


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    again = quality.fit(with_clashes(docs).repartition(7), labels)
    assert np.array_equal(model.vectors, again.vectors)
    scored = quality.scores(docs, model).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in scored if r.quality == q] for q in (1, 0))
    assert len(bad) >= 5 and np.mean([x >= 0.3 for x in good]) > 0.97
    assert np.mean([x > y for x in good for y in bad]) > 0.9
    assert all(r.predicted == (r.score >= 0.3) and (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)


def test_quality_never_learns_from_held_out_rows(spark):
    rows = [(i, "fine words" if i % 2 else "### junk $$$", i % 2) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id bigint, quality int")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = quality.fit(docs, labels), quality.fit(docs, turned)
    assert np.array_equal(one.vectors, other.vectors) and np.array_equal(one.output, other.output)
    assert one.score("fine words") > 0.7 > 0.3 > one.score("### junk $$$")


def test_quality_at_the_edges(spark):
    docs = with_clashes(spark.createDataFrame([(1, None), (1, None), (2, ""), (None, "x"), (3, "word " * 100_000)], "doc_id bigint, text string"))
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id bigint, quality int")
    for some in (labels, labels.limit(0)):
        model = quality.fit(docs, some)
        found = quality.scores(docs, model).collect()
        assert len(found) == 5 and all(0 <= r.score <= 1 for r in found)
        assert len({r.score for r in found if r.doc_id in (1, 2)}) == 1
    assert quality.scores(docs.limit(0), model).count() == 0
    assert quality.keep_good(docs, model, 0.0).columns == docs.columns and quality.keep_good(docs, model, 1.1).count() == 0


# --- 13: collocations


def plain_collocations(rows, least, longest, top):
    counts, words = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        levelled = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", levelled):
            found = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(found)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(found[i : i + size]) for i in range(len(found) - size + 1))
    for lang, own in counts.items():
        phrases = {p: n for p, n in own.items() if len(p) > 1 and n >= least}
        around = defaultdict(int)
        for p, n in phrases.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    around[p[i : i + size]] = max(around[p[i : i + size]], n)
        scored = []
        for p, n in phrases.items():
            if 100 * around[p] < 100 * n:
                score, k = min((1000 * n * words[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -n, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, n, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            yield lang, rank, phrase.decode(), -n, left, right, words[lang], -score


def phrase_rows(seed, docs=150):
    rnd = random.Random(seed)
    alphabet = [*"abcdefgh", "É", "é", "I", "i", "日本", "x y", "\x1c", "zz"]
    rows = []
    for i in range(docs):
        words = [rnd.choice(alphabet) + rnd.choice(["", "", "", ",", ".\n", " - ", "\t", "!"]) for _ in range(rnd.randrange(60))]
        rows.append((" ".join(words) + rnd.choice(["", " new york city", " of the of the of the"]), rnd.choice(["en", "en", "en", "de", None])))
    return [*rows, (None, "en"), ("", "fr"), ("...", "fr"), ("one", "xx"), *[("over and over and over again", "en")] * 40]


@pytest.mark.parametrize(("seed", "least", "longest", "top"), [(1, 5, 5, 2000), (2, 12, 4, 7), (3, 2, 2, 30), (4, 3, 7, 2000)])
def test_collocations_against_plain(spark, monkeypatch, seed, least, longest, top):
    rows = phrase_rows(seed)
    docs = with_clashes(spark.createDataFrame(rows, "text string, lang string")).withColumn("doc_id", F.lit(1)).repartition(4)
    found = collocations.collocations(docs, least, longest, top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert as_rows(found) == Counter(tuple(map(str, r)) for r in plain_collocations(rows, least, longest, top))


def test_shards_cut_texts_anywhere(monkeypatch):
    """N-grams over a cut count once: sums over shards are those of the whole."""
    rnd = random.Random(5)
    text = " ".join(rnd.choice("abcd") + rnd.choice(["", "", "", "."]) for _ in range(3000))
    keep_all = collocations.Sift(np.full(1 << (collocations.SIFT_BITS - 3), 255, np.uint8))
    monkeypatch.setattr(collocations, "SLICE", 50)

    def counted(most, low, high):
        total, shard = Counter(), collocations.Shard("en")
        last = []
        for words in collocations.slices(text):
            shard.add(words)
            last = [*last, *words][1 - high :] if high > 1 else []
            if shard.size >= most:
                add(total, shard, low, high)
                shard = collocations.Shard("en")
                shard.add(last)
                shard.seen = len(last)
        add(total, shard, low, high)
        return total

    def add(total, shard, low, high):
        for _, _, packed in shard.counts(low, high, 3, keep_all):
            automaton = Automaton.unpacked(packed)
            levels = automaton.levels()
            for depth in range(low - 1, len(levels)):
                for gram, n in zip(automata.paths(levels, depth).tolist(), levels[depth][2].tolist(), strict=True):
                    total[tuple(automaton.words[w] for w in gram)] += n

    for low, high in ((1, 1), (2, 2), (3, 5)):
        wanted = counted(1 << 30, low, high)
        assert sum(wanted.values()) > 500
        assert +counted(100, low, high) == +wanted


def test_a_full_sieve_loses_nothing(spark, monkeypatch):
    rows = phrase_rows(6, 60)
    docs = spark.createDataFrame(rows, "text string, lang string")
    full = collocations.Sift(np.full(1 << (collocations.SIFT_BITS - 3), 255, np.uint8))
    monkeypatch.setattr(collocations, "sift_of", lambda *_: full)
    assert as_rows(collocations.collocations(docs, 4)) == Counter(tuple(map(str, r)) for r in plain_collocations(rows, 4, 5, 2000))


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")
    assert collocations.collocations(docs).count() == 0 and collocations.collocations(docs.limit(0)).count() == 0


def test_scores_pass_64_bits(spark):
    big = 3_000_000_000_007
    cuts = [(1, big, big), (2, 5 * big + 1, big + 2), (3, big + 2, 5 * big + 1)]
    rows = spark.createDataFrame([(big, 7 * big, cuts)], "a bigint, n bigint, c array<struct<k: int, l: bigint, r: bigint>>")
    cut = rows.select(collocations.lowest_cut(F.col("a"), F.col("n"), F.col("c")).alias("x")).first().x
    assert 1000 * big * 7 * big > 1 << 64 and tuple(cut) == (1000 * big * 7 * big // ((5 * big + 1) * (big + 2)), *cuts[1])


# --- automata


def automaton_of(grams):
    words = sorted({w for g in grams for w in g})
    levels, prefixes = [], [()]
    for depth in range(max(map(len, grams), default=0)):
        here = sorted({g[: depth + 1] for g in grams if len(g) > depth})
        parent = np.array([prefixes.index(p[:-1]) for p in here])
        levels.append((parent, np.array([words.index(p[-1]) for p in here]), np.array([grams.get(p, 0) for p in here])))
        prefixes = here
    return Automaton.build(words, levels)


def grams_of(words, levels):
    return {
        tuple(words[w] for w in path): n
        for depth in range(len(levels))
        for path, n in zip(automata.paths(levels, depth).tolist(), levels[depth][2].tolist(), strict=True)
        if n
    }


def random_grams(rnd, most=40):
    return {tuple(rnd.choice([b"a", b"b", b"c", b"dd"]) for _ in range(rnd.randint(1, 4))): rnd.randint(1, 3) for _ in range(rnd.randrange(most))}


@pytest.mark.parametrize("seed", range(20))
def test_automata_union_cut_and_composition(seed):
    rnd = random.Random(seed)
    several = [random_grams(rnd) for _ in range(rnd.randint(1, 5))]
    built = [Automaton.unpacked(automaton_of(g).packed()) for g in several]
    for grams, automaton in zip(several, built, strict=True):
        assert grams_of(automaton.words, automaton.levels()) == grams
    total = Counter()
    for grams in several:
        total.update(grams)
    for arcs in (1, 30, 1 << 20):
        words, levels = automata.merged(iter(built), arcs)
        assert grams_of(words, levels) == dict(total)
    cut = grams_of(words, automata.at_least(levels, 4, 2))
    assert {g: n for g, n in cut.items() if len(g) > 1 and n >= 4} == {g: n for g, n in total.items() if len(g) > 1 and n >= 4}
    asked = {g: i for i, g in enumerate(sorted({*random_grams(rnd), *list(total)[:10]}), 1)}
    united = Automaton.build(words, levels)
    open_levels = united.levels()
    number, depth, at = automata.compose(automaton_of(asked), united)
    found = {n: int(open_levels[d][2][p]) if p >= 0 else 0 for n, d, p in zip(number.tolist(), depth.tolist(), at.tolist(), strict=True)}
    assert found == {n: total.get(g, 0) for g, n in asked.items()}


def test_equal_ends_are_stored_once():
    same = {(first, *rest): 5 for first in (b"a", b"b", b"c") for rest in ((b"x", b"y"), (b"x", b"z"), (b"w", b"y"))}
    automaton = automaton_of(same)
    assert len(automaton.labels) == 3 + 2 + 2 + 1 and len(automaton.levels()[2][1]) == 9
