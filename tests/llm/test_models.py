"""Operators that learn or count: language, quality, language model, tokens."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as some
from pyspark.sql import functions as F

from docquery.llm import bpe, bytewords, katz, langid
from docquery.llm import quality_gbt as gbt

RANKS = bpe.read_ranks(None, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
MERGES = bpe._Merges(RANKS)
SMALL = "/root/testdata/sf0.01"
katz_stored = katz.stored


class TestWords:
    @settings(max_examples=200, deadline=None)
    @given(some.lists(some.one_of(some.none(), some.text("aB é1.\n\x0b漢", max_size=30)), max_size=6))
    def test_bounds_and_hashes(self, texts):
        data, offsets = bytewords.buffers(pa.array(texts, pa.string()))
        for inside, pattern in ((bytewords.SPACED, r"[^\x20\x09-\x0D]+"), (bytewords.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
            starts, ends, bounds = bytewords.word_bounds(data, offsets, inside)
            words = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
            low = lambda t: (t or "").translate({c: c + 32 for c in range(65, 91)})
            assert [low(w) for w in words] == [w for t in texts for w in re.findall(pattern, low(t))]
            assert np.diff(bounds).tolist() == [len(re.findall(pattern, low(t))) for t in texts]
            hashes = bytewords.word_hashes(data, starts, ends)
            assert len(set(hashes.tolist())) == len({low(w) for w in words})


class TestLanguage:
    @settings(max_examples=60, deadline=None)
    @given(some.text("abc ", max_size=60).map(lambda t: t + "cab "), some.lists(some.text("abc ", max_size=600), min_size=1, max_size=4))
    def test_phrases(self, sample, texts):
        parser = langid.Parser({"x": sample.encode()})
        data, offsets = bytewords.buffers(pa.array(texts))
        for text, got in zip(texts, parser.phrases(data, offsets)[:, 0]):
            want = 0
            for block in (text[k : k + langid.BLOCK] for k in range(0, len(text), langid.BLOCK)):
                at = 0
                while at < len(block):
                    size = 1
                    while at + size < len(block) and block[at : at + size + 1] in sample:
                        size += 1
                    at += size
                    want += 1
            assert got == want

    def test_held_out_accuracy(self, spark):
        docs = spark.read.parquet(f"{SMALL}/documents.parquet")
        samples = langid.language_samples(docs.where(langid.remainder("doc_id", 4) != 2))
        got = langid.identify(docs.where(langid.remainder("doc_id", 4) == 2), samples).select((F.col("lang") == F.col("lang_pred")).cast("int").alias("x"), "score").collect()
        assert np.mean([r.x for r in got]) > 0.97 and all(0 <= r.score <= 1 for r in got)

    def test_odd_rows(self, odd, none):
        samples = {"a": b"some words here same text again lorem ipsum", "b": b"xyz"}
        got = {r.doc_id: r.lang_pred for r in langid.identify(odd, samples).collect()}
        assert got[1] == got[2] == got[3] == "und" and got[5] == got[None] == got[4] == "a" and got[6] in "ab"
        assert langid.identify(none, samples).count() == 0 and {r.lang_pred for r in langid.identify(odd, {}).collect()} == {"und"}
        assert langid.language_samples(none.withColumn("lang", F.lit("a"))) == {}

    def test_every_language_is_learned(self, spark):
        """More labels than any limit, and labels with long texts only."""
        rows = [(f"word{chr(97 + k % 26)}{chr(97 + k // 26)} text here", f"l{k:03}") for k in range(230)]
        rows += [("12 " * 40_000 + "é long" * 30_000, "long"), ("short one", "both"), ("q" * 70_000, "both"), ("123 !", "none")]
        samples = langid.language_samples(spark.createDataFrame(rows, "text string, lang string"))
        assert sorted(samples) == ["both", *(f"l{k:03}" for k in range(230)), "long"]
        assert b"q" not in samples["both"] and 59_990 <= len(samples["long"]) <= langid.SAMPLE_BYTES + 1 and samples["long"].decode().count("é long") > 8_000

    def test_blocks_of_languages_change_nothing(self, spark):
        docs = spark.read.parquet(f"{SMALL}/documents.parquet")
        samples = {f"{k}{n}": v[n : n + 2000] for k, v in langid.language_samples(docs).items() for n in (0, 1000)}
        assert len(langid.language_blocks(samples, 1 << 21)) > 2 and len(langid.language_blocks(samples, langid.TABLE_BYTES)) == 1
        one, many = (sorted((r.doc_id, r.lang_pred, round(r.score, 12)) for r in langid.identify(docs.select("doc_id", "text"), samples, table_bytes=n).collect()) for n in (langid.TABLE_BYTES, 1 << 21))
        assert one == many and len({x[1] for x in one}) > 3


class TestQuality:
    def test_learns(self):
        rng = np.random.default_rng(1)
        x = rng.normal(size=(2000, len(gbt.NAMES)))
        y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
        forest = gbt.train(x[:1500], y[:1500])
        assert ((forest.score(x[1500:]) >= 0.5) == y[1500:]).mean() > 0.9

    def test_degenerate(self):
        x = np.zeros((3, len(gbt.NAMES)))
        assert gbt.train(x[:0], np.zeros(0)).score(x).tolist() == [0.5] * 3
        assert gbt.train(x, np.ones(3)).score(x).min() > 0.99
        assert np.isfinite(gbt.train(x, np.array([0.0, 1.0, 1.0])).score(x)).all()

    def test_held_out_accuracy(self, spark):
        docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
        forest = gbt.fit(docs, labels.where(langid.remainder("doc_id", 3) != 1))
        got = gbt.classify(docs.select("doc_id", "text"), forest).join(labels.where(langid.remainder("doc_id", 3) == 1), "doc_id").collect()
        assert np.mean([r.predicted == r.quality for r in got]) > 0.95

    def test_odd_rows(self, spark, odd, none):
        labels = spark.createDataFrame([(1, 0), (5, 1), (5, 1), (None, 1), (4, None)], "doc_id long, quality int")
        forest = gbt.fit(odd, labels)
        got = gbt.classify(odd, forest).collect()
        assert len(got) == 8 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got) and gbt.classify(none, forest).count() == 0


class TestKatz:
    def brute(self, docs, learn):
        tokens = {k: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) + ["</s>"] for k, t in docs}
        uni = Counter(w for k in learn for w in tokens[k])
        two, before = Counter(), Counter()
        for k in learn:
            for h, w in zip(["<s>", *tokens[k]], tokens[k]):
                two[h, w] += 1
                before[h] += 1
        n, v = sum(uni.values()), len(uni)

        def discounts(counts):
            return katz.Discounts.of([0, *[sum(c == r for c in counts.values()) for r in range(1, katz.K + 2)]])

        d1, d2 = discounts(uni), discounts(two)
        mass = lambda d, r: float(d.mass(np.array([r]))[0])
        low = {w: mass(d1, r) / n for w, r in uni.items()}
        unknown = 1 - sum(low.values())
        seen, lower = Counter(), Counter()
        for (h, w), r in two.items():
            seen[h] += mass(d2, r) / before[h]
            lower[h] += low[w]

        def p(h, w):
            if r := two.get((h, w)):
                return mass(d2, r) / before[h]
            return (1 if h not in before else (1 - seen[h]) / (1 - lower[h])) * low.get(w, unknown)

        for h in [*before, "never"]:  # exactly normalised over the vocabulary and the unknown word
            assert math.isclose(sum(p(h, w) for w in uni) + p(h, "unknown word"), 1, rel_tol=1e-9)
        out = {}
        for k, own in tokens.items():
            out[k] = (len(own), sum(w in uni for w in own), n, sum(math.log10((uni.get(w, 0) + 1) / (n + v + 1)) for w in own), sum(math.log10(p(h, w)) for h, w in zip(["<s>", *own], own)))
        return out

    @pytest.mark.parametrize("seed", [1, 2])
    def test_against_brute_force(self, spark, seed):
        rng = np.random.default_rng(seed)
        docs = [(k, " ".join(rng.choice(["a", "B", "c", "dd", "é", "fox", "gnu", f"x{k % 7}"], rng.integers(0, 40), p=[0.3, 0.2, 0.15, 0.1, 0.1, 0.05, 0.05, 0.05]))) for k in range(60)]
        want = self.brute(docs, [k for k, _ in docs if zlib.crc32(str(k).encode()) % 7 != 2])
        got = katz.score(spark.createDataFrame(docs, "doc_id int, text string"), langid.remainder("doc_id", 7) != 2).collect()
        assert len(got) == 60
        for r in got:
            n, known, total, base, score = want[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
            assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)

    @settings(max_examples=100, deadline=None)
    @given(some.lists(some.integers(0, 2**48 - 1), max_size=40), some.lists(some.floats(-1e5, 0), max_size=20))
    def test_packing(self, histories, sums):
        own = np.array(histories, np.uint64)
        assert katz._histories(katz._steps(own)).tolist() == histories and katz._grown(katz._shrunk(own), np.uint64).tolist() == histories
        assert np.allclose(katz._float(katz._fixed(np.array(sums, float))), sums, rtol=0, atol=2.0**-32)

    def test_tables(self, spark, monkeypatch):
        """Small partitions give the same scores, and the table of bigrams has each count."""
        docs, found = spark.createDataFrame([(k, f"a b c{k % 3} a b") for k in range(50)], "doc_id long, text string"), []
        want = {r.doc_id: r.score for r in katz.score(docs, F.lit(True)).collect()}
        monkeypatch.setattr(katz, "PART_BYTES", 40)
        monkeypatch.setattr(katz, "stored", lambda df, *names: found.append(katz_stored(df, *names)) or found[-1])
        got = {r.doc_id: r.score for r in katz.score(docs, F.lit(True), bigrams=True).collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)
        counts = Counter()
        for r in found[1].where("kind = 'bigrams'").collect():
            w, v, n = (katz._grown(x, t) for x, t in zip((r.a, r.b, r.c), (np.uint64, np.uint64, np.int64)))
            counts.update(dict(zip(zip(w.tolist(), v.tolist()), n.tolist())))
        assert sorted(counts.values()) == sorted([50, 100, 50, *[17, 17, 16] * 2])

    def test_odd_rows(self, odd, none):
        got = katz.score(odd, F.col("doc_id") > 0).collect()
        assert len(got) == 8 and all(np.isfinite(r.score) and r.n_tokens >= 1 for r in got)
        assert next(r.n_tokens for r in got if r.doc_id == 4) == 60_001 and katz.score(none, F.lit(True)).count() == 0
        alone = katz.score(odd, F.lit(False)).collect()
        assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == 0 for r in alone)


class TestBpe:
    @settings(max_examples=300, deadline=None)
    @given(some.text(max_size=40).map(lambda t: t.encode("utf-8", "ignore")))
    def test_fold(self, word):
        assert not word or bpe.fold(word, RANKS) == ENCODING._core_bpe.encode_single_piece(word)

    def test_long_word(self):
        word = ("ab" * 5000).encode()
        assert bpe.fold(word, RANKS) == ENCODING._core_bpe.encode_single_piece(word)

    @settings(max_examples=100, deadline=None)
    @given(some.lists(some.one_of(some.text(min_size=1, max_size=12), some.text("abcé", min_size=1, max_size=48)), max_size=30))
    def test_words_that_are_merged_together(self, words):
        """Words that the table lacks are merged many at a time, with the ids of ``fold``; only pieces and long words are left to it."""
        words = {w for w in words if w.encode("utf-8", "ignore") == w.encode("utf-8", "replace")}
        ids = bpe._Ids(bpe._Table([]), RANKS, MERGES)
        ids.learn(words)
        assert ids.keys() == {w for w in words if len(w.encode()) <= 48 and w.encode() not in RANKS}
        for w in words:
            assert np.frombuffer(ids[w], np.int32).tolist() == bpe.fold(w.encode(), RANKS) == ENCODING._core_bpe.encode_single_piece(w.encode())

    def test_merged_bytes_without_a_rank(self):
        few = {b"a": 0, b"b": 1, b"ab": 2, b"cd": 3}
        assert [np.frombuffer(x, np.int32).tolist() for x in bpe._Merges(few).fold([b"abab", b"cdab", b"b" * 5])] == [[2, 2], [3, 2], [1] * 5]
        with pytest.raises(KeyError):
            bpe._Merges(few).fold([b"abc"])

    def test_words_by_higher_order_functions(self, spark):
        words = ["", "a", " the", "zqxj", "naïve", "漢字", " 🎈🎈", "aaaaaaaa", "\n\n", "Donaudampfschiff"]
        got = bpe.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), RANKS).collect()
        assert {r.word: r.ids for r in got} == {w: ENCODING._core_bpe.encode_single_piece(w.encode()) if w else [] for w in words}

    def test_words_that_the_fold_sees(self, spark):
        """Each word that a task meets twice is folded, and with a lower limit those that stand more often; ids are the same."""
        rows = [("one one two two two three three three three four-four-four " + "y" * 300 + " " + "y" * 300,), ("one five 漢字漢字 naïve naïve",)]
        docs = spark.createDataFrame(rows, "text string").coalesce(1)
        want = [ENCODING.encode_ordinary(r[0]) for r in rows]
        for limit, folded in ((bpe.CACHE_WORDS, {" one": 0, " two": 3, " three": 4, "-": 2, "four": 0, " naïve": 2}), (2, {" three": 4}), (0, {})):
            got = {r.word: r.n for r in bpe.repeated_words(docs, public_tokenizers.PATTERN, limit=limit).collect()}
            assert all(got[w] == n for w, n in folded.items() if n) and (limit > 2 or len(got) <= limit) and not any(len(w) > 200 for w in got)
            assert sorted(r.ids for r in bpe.encode(docs, RANKS, public_tokenizers.PATTERN, limit=limit).collect()) == sorted(want)

    def test_table(self):
        """A word whose first hash is another's is not taken for it."""
        (h,), (c,) = bpe._hashes(["hello"])
        part = lambda check: tuple(np.array(x, t).tobytes() for x, t in (([h], np.uint64), ([check], np.uint32), ([2], np.int32), ([5, 6], np.int32)))
        for check, want in ((c, [5, 6]), (c ^ 1, ENCODING.encode_ordinary("hello"))):
            ids = bpe._Ids(bpe._Table([part(check)]), RANKS)
            ids.learn({"hello", "other"})
            assert np.frombuffer(ids["hello"], np.int32).tolist() == want and np.frombuffer(ids["other"], np.int32).tolist() == ENCODING.encode_ordinary("other")

    def test_round_trip(self, odd, none):
        encoded = bpe.encode(odd, RANKS, public_tokenizers.PATTERN, with_text=True)
        got = bpe.decode(encoded, RANKS).collect()
        assert len(got) == 8
        for r in got:
            assert r.ids == ENCODING.encode_ordinary(r.text or "") and bytes(r.decoded).decode() == (r.text or "")
        assert bpe.encode(none, RANKS, public_tokenizers.PATTERN).count() == 0
