"""Operators that judge each text on its own: rules, decontamination, licenses, personal data."""

import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as some

from docquery.llm import decontaminate as dc
from docquery.llm import licenses, pii
from docquery.llm.quality_rules import measures, quality_rules

SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def texts(seed, alphabet, n, longest=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n)]


class TestQualityRules:
    def test_measures(self, spark):
        values = texts(1, "ab #\n\t\x0b|é  ", 400)
        got = quality_rules(spark.createDataFrame(list(enumerate(values)), "doc_id int, text string")).collect()
        assert len(got) == 400
        for r in got:
            words = re.findall(SPACED, r.text)
            windows = Counter(zip(words, words[1:], words[2:]))
            covered = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
            lines = [x for x in r.text.split("\n") if re.search(SPACED, x)]
            want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", r.text)), len(lines) - len(set(lines)), len(covered))
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want

    @pytest.mark.parametrize("options", [{"hash_bits": 1}, {"hash_bits": 3}, {"long_text": 5}, {"hash_bits": 2, "long_text": 20}])
    def test_colliding_windows_and_long_texts(self, spark, options):
        """Few hash bits put other windows between equal ones; long texts need more bits of position."""
        values = texts(3, "ab   ", 300, 120)
        got = measures(spark.createDataFrame(list(enumerate(values)), "doc_id int, text string"), **options).collect()
        assert len(got) == 300
        for r in got:
            words = re.findall(SPACED, r.text)
            windows = Counter(zip(words, words[1:], words[2:]))
            covered = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
            assert (r.n_words, r.n_repeat_words) == (len(words), len(covered)), r.text

    def test_odd_rows(self, odd, none):
        got = quality_rules(odd)
        assert got.count() == 8 and got.where("NOT base_failed").count() == 0 and quality_rules(none).count() == 0
        assert got.where("doc_id = 4").first().n_words == 60_000 and "score" in got.columns

    def test_clean_text_stays(self, spark):
        text = " ".join(f"the word{i} of text{i} and more{i}." for i in range(20))
        r = quality_rules(spark.createDataFrame([(1, text), (2, text.replace(".", "!! ###$ |")), (3, text.upper())], "doc_id int, text string")).orderBy("doc_id").collect()
        assert [x.kept for x in r] == [True, False, False] and r[1].failed_rules == ["symbol_ratio"]

    def test_plan_is_native(self, odd):
        plan = quality_rules(odd)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


class TestDecontaminate:
    def brute(self, docs, items, n):
        out = {}
        grams = {}
        for item, text in items:
            w = re.findall(ALNUM, lowered(text))
            size = min(n, len(w))
            for k in range(len(w) - size + 1 if size else 0):
                grams.setdefault(tuple(w[k : k + size]), set()).add(item)
        for key, text in docs:
            w, hit, found = re.findall(ALNUM, lowered(text)), set(), set()
            for g, ids in grams.items():
                for k in range(len(w) - len(g) + 1):
                    if tuple(w[k : k + len(g)]) == g:
                        hit |= set(range(k, k + len(g)))
                        found |= {str(i) for i in ids if i is not None}
            out[key] = (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
        return out

    @pytest.mark.parametrize("n,block_chars", [(1, 10**6), (2, 20), (3, 10**6), (13, 40)])
    def test_against_brute_force(self, spark, n, block_chars):
        d, i = list(enumerate(texts(n, "aB é,.\n ", 60))), [(k if k else None, t) for k, t in enumerate(texts(n + 50, "aB é, ", 6, 30))]
        got = dc.decontaminate(spark.createDataFrame(d, "doc_id int, text string"), spark.createDataFrame(i, "item_id int, text string"), n, block_chars=block_chars).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r.hit_items, r.contaminated) for r in got} == self.brute(d, i, n)

    def test_spans_and_cut_text(self, spark):
        docs = spark.createDataFrame([(1, "é One, TWO three four."), (2, "nothing here")], "doc_id int, text string")
        r = dc.decontaminate(docs, spark.createDataFrame([(7, "two three")], "item_id int, text string"), with_text=True).orderBy("doc_id").collect()
        assert [tuple(s) for s in r[0].hit_spans] == [(7, 16)] and r[0].clean_text == "é One,  four." and r[1].clean_text == "nothing here"

    def test_odd_rows(self, spark, odd, none):
        items = spark.createDataFrame([(1, "same text"), (1, "same text"), (None, "some words"), (2, None), (3, "")], "item_id long, text string")
        got = {(r.doc_id, r.n_hit, r.contaminated) for r in dc.decontaminate(odd, items).collect()}
        assert got == {(1, 0, False), (2, 0, False), (None, 2, True), (3, 0, False), (4, 0, False), (5, 2, True), (6, 0, False)}
        assert dc.decontaminate(none, items).count() == 0 and dc.decontaminate(odd, items.where("item_id > 9")).where("contaminated").count() == 0


class TestLicenses:
    def one(self, spark, text):
        return licenses.scan(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()

    def test_base_and_fuzzy(self, spark):
        r = self.one(spark, "Released UNDER the-MIT\nlicense. Again: under the mit license; CC-BY-NC")
        assert (r.n_base, r.first_word, r.last_word, r.base_labels, r.score) == (3, 1, 10, "cc-by-nc,mit", 1.0)
        r = self.one(spark, "code undr the mit licence only")
        assert (r.n_base, r.base_labels, r.labels) == (0, "", "mit") and 0.8 < r.score < 1
        assert [(x.first_word, x.last_word, x.edits) for x in r.notices if x.label == "mit"] == [(1, 4, 2)]
        assert self.one(spark, "under the unit of lice").labels == ""

    def test_no_verified_match_is_missed(self):
        """Every edit of a notice within its bound is found by its pieces."""
        import random

        rng = random.Random(5)
        for notice in licenses.compiled():
            for _ in range(20):
                text = list(notice.phrase)
                for _ in range(rng.randint(0, notice.edits)):
                    k = rng.randrange(1, len(text) - 1)
                    text[k : k + 1] = rng.choice([["x"], [], [text[k], "y"]])
                own = "aa " + "".join(text) + " bb"
                assert list(notice.matches(own)), (notice.phrase, own)

    def test_adjacent_notices_against_brute_force(self):
        """Each of several notices in one window is found, however close the others are; edits are the least there are."""

        def distance(a, b):
            row = list(range(len(b) + 1))
            for i, x in enumerate(a, 1):
                row, last = [i], row
                for j, y in enumerate(b, 1):
                    row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
            return row[-1]

        rng = random.Random(7)
        for notice in licenses.compiled():
            for _ in range(6):
                parts, text = [], ""
                for _ in range(4):
                    own = list(notice.phrase)
                    for k in rng.sample(range(2, len(own) - 2), rng.randint(0, notice.edits)):
                        own[k] = "z"
                    parts.append((len(text), len(text) + len(own), "".join(own)))
                    text += "".join(own) + " "
                got = sorted(notice.matches(text))
                assert len(got) == len(parts), (text, got)
                for (a, b, own), (start, end, edits) in zip(parts, got):
                    assert max(a, start) < min(b, end) and edits <= distance(own, notice.phrase) and distance(text[start:end], notice.phrase) <= notice.edits

    def test_word_borders(self, spark):
        for text in ("all rights reservedly so", "the gnu general public licenseeship", "xunder the mit licensing", "a dedicatedly to the public domains x"):
            assert self.one(spark, text).labels in ("", "public-domain") and not self.one(spark, text).labels.startswith(("all", "gpl", "mit")), text
        r = self.one(spark, "é all rights reserved, under the mit licenses é")
        assert [(x.label, x.first_word, x.last_word, x.edits) for x in r.notices] == [("all-rights-reserved", 1, 3, 0), ("mit", 4, 7, 1)]
        assert r.n_base == 0 and r.labels == "all-rights-reserved,mit"

    def test_base_places_in_a_long_text(self):
        words = ("x " * 5_000 + "under the mit license é " * 3_000).split()
        row = licenses.scan_text(" ".join(words).encode(), [], [])
        assert row[:4] == (len(words), 3_000, 5_000, len(words) - 5)

    def test_order_of_adjacent_notices(self, spark):
        r = self.one(spark, "under the mti license under the mit license")
        assert [(x.first_word, x.last_word, x.edits) for x in r.notices if x.label == "mit"] == [(0, 3, 2), (4, 7, 0)]

    def test_odd_rows(self, odd, none):
        got = licenses.scan(odd).collect()
        assert len(got) == 8 and all(r.labels == "" and r.score == 0 and r.first_word is None for r in got) and licenses.scan(none).count() == 0


class TestPii:
    RULES = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: pii._luhn(m)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= sum(c.isdigit() for c in m) <= 15),
    )

    @settings(max_examples=400, deadline=None)
    @given(some.text("a1@.+- ()é4567", max_size=60))
    def test_base(self, text):
        want = [(kind, m.start(), m.end()) for kind, p, check in self.RULES for m in re.finditer(p, text) if check(m.group())]
        assert pii.base_spans(text) == want

    def test_luhn(self):
        assert pii._luhn("4111 1111-1111 1111") and not pii._luhn("4111111111111112") and not pii._luhn("0" * 20)

    def test_patterns_find_unseen_identifiers(self, spark):
        good = ["4111111111111111", "5500005555555559", "4012888888881881", "378282246310005", "6011111111111117"]
        rows = [(i, f"your card number {c} is on file") for i, c in enumerate(good)] + [(9, "your card number 4111111111111112 is on file"), (10, "in the year 1234567890123456 bc")]
        got = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
        assert got[9] == "context:17:33" and got[10] == "" and got[0] == "card:17:33"

    def test_shapes_that_no_base_kind_has(self, spark):
        """The first round reaches new shapes by words alone; what it finds makes a pattern of the second."""
        good = [f"user{k}@mail{k}.example" for k in range(15)]
        phones = [f"+49 30 12345{k:02}" for k in range(4)]
        found, unseen = ["AB-12345", "CD-67890", "EF-24680", "GH-11223", "IJ-44556"], "XY/13579/Q"
        texts = [f"the customer id {c} was seen" for c in good + found] + [f"please call {p} today" for p in phones]
        texts += [f"under ledger key {x} it says" for x in [*found, unseen]] + ["please call 0301234567 today", "please call (030) 123 4567 today", "nothing like part 99-12345 here"]
        got = {t: s for t, s in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), with_text=True).select("text", "spans").collect()}
        for text, token in [(f"the customer id {x} was seen", x) for x in found] + [(f"under ledger key {unseen} it says", unseen), (texts[-3], "0301234567"), (texts[-2], "(030) 123 4567")]:
            assert got[text] == f"context:{text.index(token)}:{text.index(token) + len(token)}", text
        assert got[texts[-1]] == ""
        one = {t: s for t, s in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), rounds=1, with_text=True).select("text", "spans").collect()}
        assert one[f"under ledger key {unseen} it says"] == "" and one["the customer id AB-12345 was seen"] != ""

    def test_secrets_and_recall(self, spark):
        """Secret-like tokens seed the words about them, and these find what looks otherwise; a word is never cut."""
        rng = random.Random(4)
        words = lambda n: " ".join("".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 9))) for _ in range(n))
        secrets = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(30)] + [f"k{rng.randrange(10**7):07}-{k}" for k in range(10)]
        planted = [f'{words(40)} token = "{x}" {words(40)}' for x in secrets]
        clean = [f"{words(60)} {rng.randrange(10**9)} {words(60)}" for _ in range(60)] + ["x" * 80 + " 1234567 " + "y" * 80]
        docs = spark.createDataFrame(list(enumerate(planted + clean)), "doc_id int, text string")
        want = None
        for limit in (pii.BROADCAST, 0):  # broadcast patterns, and joined ones
            got = {r.doc_id: (r.spans, r.n_context) for r in pii.find(docs, limit=limit).collect()}
            hit = [f"context:{t.index(x)}:{t.index(x) + len(x)}" in got[k][0].split(",") for k, (x, t) in enumerate(zip(secrets, planted))]
            assert sum(hit) >= 0.9 * len(hit) and sum(got[k][1] for k in range(len(planted), len(got))) == 0
            assert want is None or got == want
            want = got
        assert pii._patterns(clean[-1], 81, 88) == [] and pii._SECRET.fullmatch("a1" * 16) and not pii._SECRET.fullmatch("1" * 40) and not pii._SECRET.fullmatch("ab" * 20)

    def test_long_text_with_hits(self, spark):
        filler = "lorem ipsum dolor " * 20_000
        r = pii.find(spark.createDataFrame([(1, f"{filler}a.b@c.de {filler}")], "doc_id int, text string")).first()
        assert r.spans == f"email:{len(filler)}:{len(filler) + 8}" and r.n_email == 1

    def test_runs_of_tokens(self):
        def runs(text):
            return [text[a:b] for a, b, *_, own in pii.candidates(text, pii.base_spans(text)) if own and " " in text[a:b]]

        assert runs("iban GB82 WEST 1234 5698 7654 32, then") == ["GB82 WEST 1234 5698 7654 32"] and runs("in 2019, 1234567 or (030) 77 8899.") == ["(030) 77 8899"]
        assert runs("a@b.c1 1234567 x1 and 1234567\n7654321") == ["1234567 x1"] and "".join(runs(" ".join(f"{k:06}" for k in range(20)))).count("0000") == 20

    def test_words_before_anything_are_no_pattern(self, spark):
        good = ["4111111111111111", "5500005555555559", "4012888888881881", "378282246310005", "6011111111111117"]
        rows = [(i, f"w{i} of {c} x{i}") for i, c in enumerate(good)] + [(9, "made of AB-123456 then"), (10, " ".join(f"{a}{b}ing of" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz" * 20))]
        got = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
        assert got[9] == ""

    def test_every_plain_word_counts(self, spark):
        """Words of short texts are no pattern where plain words follow them, whichever texts these stand in."""
        rows = [f"w{k} near u{k}@mail{k}.example z{k}" for k in range(8)] + ["made near AB-123456 then"] + [f"near {a}{b} it" for a in "abcdef" for b in "xyz"]
        for limit in (pii.BROADCAST, 0):  # 8 seeds of 9 instances and 18 plain words
            got = {r.text: r.spans for r in pii.find(spark.createDataFrame([(r,) for r in rows], "text string"), with_text=True, limit=limit).collect()}
            assert got[rows[8]] == "" and got[rows[0]] != ""
            few = {r.text: r.spans for r in pii.find(spark.createDataFrame([(r,) for r in rows[:16]], "text string"), with_text=True, limit=limit).collect()}
            assert few[rows[8]] == "context:10:19"  # 8 of 16: each word is counted, and counted once

    @settings(max_examples=300, deadline=None)
    @given(some.lists(some.sampled_from(["the", "Of", "(de", "a.", "=", "-", "é,", "x" * 30, "y" * 64, "12", "AB-12345", "a@b.c", "@home", "+1 - 2345 6789", " ", "\n", "\u2003"]), max_size=14).map(" ".join))
    def test_plain_words_have_the_patterns_of_instances(self, text):
        base, want = pii.base_spans(text), set()
        for m in re.finditer(r"\S+", text):
            own = m.group().strip(pii._EDGE)
            a = m.start() + m.group().index(own)
            b = a + len(own)
            if own and not re.search("[0-9]", own) and not any(x < b and a < y for _, x, y in base):
                want |= {(p, own) for p in pii._lexical(text, a, b)}
        assert pii.plain_words(text) == want
        known = frozenset(sorted({p for p, _ in want})[::2])
        assert pii.plain_words(text, known, frozenset(map(pii._beside, known))) == {w for w in want if w[0] in known}

    def test_the_pipeline_counts_every_plain_word(self, spark):
        from corpus_pipeline import COLUMNS, personal_data

        rows = [f"w{k} near u{k}@mail{k}.example z{k}" for k in range(8)] + ["made near AB-123456 then"] + [f"near {a}{b} it" for a in "abcdef" for b in "xyz"]
        docs = spark.createDataFrame([(k, r, "en", "web", len(r)) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
        got = {r.doc_id: r.text for r in personal_data(spark, docs, "").select(COLUMNS).collect()}
        assert len(got) == len(rows) and got[0] == "w0 near [EMAIL] z0" and got[8] == rows[8]

    def test_redaction(self, spark):
        docs = spark.createDataFrame([(1, "é mail a.b@c.de, ip 1.2.3.4."), (2, None), (3, "clean")], "doc_id int, text string")
        assert {r.doc_id: r.text for r in pii.redact(docs).collect()} == {1: "é mail [EMAIL], ip [IP].", 2: None, 3: "clean"}

    def test_odd_rows(self, odd, none):
        got = pii.find(odd).collect()
        assert len(got) == 8 and all(r.spans == "" and r.n_email == 0 for r in got) and pii.find(none).count() == 0
