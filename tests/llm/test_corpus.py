"""Operators over the corpus as a whole: near duplicates, archives, the pipeline."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as some

from docquery.llm import jaccard_join as jj
from docquery.llm import queries, shared, warc
from docquery.llm.components import components


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()


def brute(docs):
    sets = {k: shingles(t) for k, t in docs}
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in sets}


def corpus(seed, n=150):
    """Copies and near copies of all degrees, in chains too, with a passage that many share."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    passage = " ".join(f"p{i}" for i in range(30))
    docs = []
    for k in range(n):
        if docs and rng.random() < 0.6:
            words = rng.choice(docs)[1].split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
                if words:
                    words[rng.randrange(len(words))] = word()
            if rng.random() < 0.2:
                words = words[: -rng.randint(1, 10)] or words
        else:
            words = [word() for _ in range(rng.choice([0, 2, 4, 5, 8, 40, 90]))] + (passage.split() if rng.random() < 0.4 else [])
        docs.append((k, " ".join(words)))
    rng.shuffle(docs)
    return docs


class TestJaccard:
    @settings(max_examples=200, deadline=None)
    @given(some.lists(some.sets(some.integers(0, 25)).map(sorted), max_size=9), some.integers(1, 9))
    def test_divide_skip(self, lists, least):
        lists = [x for x in lists if x]
        want = sorted((d, c) for d in range(26) if (c := sum(d in x for x in lists)) >= least)
        assert sorted(jj.divide_skip(lists, least)) == want

    @settings(max_examples=100, deadline=None)
    @given(some.lists(some.sets(some.integers(0, 12), min_size=1), min_size=1, max_size=12), some.integers(1, 100))
    def test_index(self, sets, threshold):
        """Each search of an index finds all that its set links to, with the probes of many lists at once."""
        index = jj._Index([np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15 >> 3) for s in sets], threshold)
        index.sets = [np.sort(s) for s in index.sets]
        for q, own in enumerate(sets):
            want = [k for k, s in enumerate(sets) if k != q and own & s and 100 * len(own & s) >= threshold * len(own | s)]
            assert sorted(index.search(q)) == want

    def test_links_across_the_parts_of_a_block(self):
        """What the parts of a block leave apart is found by the sets that are asked."""
        sets = [np.arange(k, k + 20, dtype=np.uint64) for k in range(0, 40, 2)]
        found = dict(jj.search_parts(list(range(20)), sets, [0] * 10 + list(range(10, 20)), [k >= 10 for k in range(20)], 0, 75))
        assert set(found.values()) == {0}

    @pytest.mark.parametrize("seed,block", [(1, 20_000), (2, 20_000), (3, 7), (4, 3), (5, 2)])
    def test_against_brute_force(self, spark, seed, block):
        docs = corpus(seed)
        got = jj.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), block_sets=block).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs)

    def test_odd_rows(self, odd, none):
        got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jj.jaccard_components(odd).collect())
        assert got == [(0, 1, None), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 3, 4), (5, 1, 5), (5, 1, 5), (6, 1, 6)]
        assert jj.jaccard_components(none).count() == 0

    @pytest.mark.parametrize("size,jobs", [(1 << 23, 4), (1 << 17, 8)])
    def test_a_bit_map_takes_few_jobs(self, spark, monkeypatch, size, jobs):
        """The driver keeps what it knows of every job, so a map does not take one for each of the shuffle's partitions."""
        monkeypatch.setattr(jj, "PIECES", size, raising=False)
        held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
        old = {k: spark.conf.get(k) for k in held}
        try:
            for k, v in held.items():
                spark.conf.set(k, v)
            ids = spark.range(20_000).selectExpr("xxhash64(id) AS set")
            spark.sparkContext.setJobGroup(f"map-{size}", "")
            marks = jj._marked(ids, "set", 200_000)  # four pieces
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
            for k, v in old.items():
                spark.conf.set(k, v)
        slots = {(r["set"] & (1 << 64) - 1) >> 42 for r in ids.collect()}
        assert len(marks) == 1 << 19 and set(np.flatnonzero(np.unpackbits(marks, bitorder="little")).tolist()) == slots
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"map-{size}")) <= jobs

    def test_components(self, spark):
        chain = [(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)]
        got = {r.node: r.root for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
        assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}
        assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_a_task_gives_its_memory_back():
    pinned = []

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4 / 1024

    def run(batches):
        held = [bytes(1000) for _ in range(200_000)]
        pinned.append(bytes(1000))  # what is free below it stays with the process by itself
        del held[:1000]
        yield from batches

    got = shared.trimmed(run)(iter([1, 2]))
    assert next(got) == 1
    most = resident()
    assert list(got) == [2] and resident() < most - 100


class TestWarc:
    PAGES = [(1, "http://a/ b", "x" * 1000), (2, "http://c", "x" * 1000), (3, None, "x" * 1000), (4, "http://d", "small"), (5, "http://e", "small"), (6, "http://f", None), (7, "http://g", "é\n\nHTTP/1.1 200\r\n\r\nWARC/1.0\r\n" * 60), (None, "http://h", "x" * 1000)]

    def test_archives(self, spark, tmp_path):
        pages = spark.createDataFrame(self.PAGES, "page_id long, url string, html string").repartition(3)
        arc, out = f"file://{tmp_path}/arc", f"file://{tmp_path}/warc"
        warc.write_arc(pages, arc)
        warc.convert(spark, arc, out)
        rows = warc.read_warc(spark, out).collect()
        by = {r.rank: r for r in rows}
        assert len(rows) == len(self.PAGES)
        for key, _, html in self.PAGES:
            raw = (html or "").encode()
            assert (by[key].payload_bytes, by[key].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        assert {k: r.record_type for k, r in by.items()} == {1: "revisit", 2: "revisit", None: "revisit", 3: "response", 4: "response", 5: "response", 6: "response", 7: "response"}
        assert {by[k].refers_to_id for k in (1, 2, None)} == {by[3].record_id}
        assert by[1].uri == "http://a/%20b" and by[3].uri == "unknown:"

    def test_the_query_parses_its_archives_once(self, spark, tmp_path):
        """The three uses of the records read a stored table instead of parsing the WARC files each."""
        spark.createDataFrame(self.PAGES, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
        out = queries.QUERIES["op8_warc"](spark, str(tmp_path))
        assert "MapInArrow" not in out._jdf.queryExecution().executedPlan().toString()
        got = {r.page_id: (r.record_type, r.refers_to) for r in out.collect()}
        assert got == {1: ("revisit", 3), 2: ("revisit", 3), None: ("revisit", 3), **{k: ("response", None) for k in range(3, 8)}}

    def test_files_are_gzip_members(self, spark, tmp_path):
        import gzip

        pages = spark.createDataFrame(self.PAGES, "page_id long, url string, html string").coalesce(1)
        warc.write_arc(pages, f"file://{tmp_path}/arc")
        (file,) = (tmp_path / "arc").glob("part-*")
        text = gzip.decompress(file.read_bytes())
        assert text.startswith(b"filedesc://pages-000000.arc.gz 0.0.0.0 ") and b"\n1 0 archive\n" in text

    @pytest.mark.parametrize("version", [1, 2])
    def test_versions(self, version):
        block = b"HTTP/1.0 200 OK\r\n\r\nbody\n\n"
        raw = warc.arc_head(version, "f.arc") + warc.arc_record("http://x/a", "19990102030405", "text/html", block, version) + b"\n" + warc.arc_record("http://y/has space", "199901020304", "text/plain", b"", version)
        for content in (raw, warc.member(raw)):
            got = list(warc.parse_arc(content))
            assert [(r["URL"], r["block"]) for r in got] == [("http://x/a", block), ("http://y/has space", b"")]
        with pytest.raises(ValueError):
            list(warc.parse_arc(raw[:-30] if version == 1 else raw[:150]))
        assert warc.warc_date("19990102030405") == "1999-01-02T03:04:05Z" and warc.warc_date("199901020304") == "1999-01-02T03:04:00Z"

    def test_large_member_ends_with_zero(self):
        assert warc.member(b"x" * (1 << 24))[-1] == 0 and b"".join(warc.members(warc.member(b"x" * (1 << 24)))) == b"x" * (1 << 24)

    def test_empty(self, spark, tmp_path):
        pages = spark.createDataFrame([], "page_id long, url string, html string")
        warc.write_arc(pages, f"file://{tmp_path}/arc")
        warc.convert(spark, f"file://{tmp_path}/arc", f"file://{tmp_path}/warc")
        assert warc.read_warc(spark, f"file://{tmp_path}/warc").count() == 0


class TestPipeline:
    def test_stages(self, spark, tmp_path):
        pipeline = pytest.importorskip("corpus_pipeline")
        rng = random.Random(3)
        prose = lambda n: " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else f"word{rng.randrange(10**6)}" for _ in range(n))
        clean, leaked = prose(120), prose(20)
        texts = [clean, clean, clean.replace("the", "the", 1) + " tail", prose(90), leaked + " " + prose(60), prose(80) + " write to a.b@c.de now", "short", None]
        rows = [(k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(texts)]
        (tmp_path / "sf").mkdir()
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/sf/documents.parquet")
        spark.createDataFrame([(1, leaked)], "item_id long, text string").write.parquet(f"{tmp_path}/sf/benchmark.parquet")
        docs, seen = spark.read.parquet(f"{tmp_path}/sf/documents.parquet"), []
        for name, stage in pipeline.STAGES:
            docs = pipeline.stored(stage(spark, docs, f"{tmp_path}/sf"), "test")
            seen.append(sorted(r.doc_id for r in docs.select("doc_id").collect()))
            if name == "personal data":
                r = docs.where("doc_id = 5").first()
                assert "[EMAIL]" in r.text and "@" not in r.text and r.n_chars == len(r.text) and docs.columns == pipeline.COLUMNS
        assert seen == [[0, 1, 2, 3, 4, 5], [0, 3, 4, 5], [0, 3, 5], [0, 3, 5], [0, 3, 5]]
        assert docs.where("doc_id = 0").first().decoded_sha256 == hashlib.sha256(clean.encode()).hexdigest()

    def test_rows_that_share_an_id_or_have_none(self, spark):
        pipeline = pytest.importorskip("corpus_pipeline")
        one, two, three = (" ".join(f"{w}{k}" for k in range(40)) for w in ("one", "two", "three"))
        rows = [(1, one), (1, one + " more"), (2, two), (None, two), (None, three), (None, three), (None, three + " more"), (3, one), (4, ""), (None, None)]
        docs = spark.createDataFrame([(k, t, "en", f"s{n}", 1) for n, (k, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
        got = pipeline.near_duplicates(spark, docs, "").collect()
        assert sorted((r.doc_id or 0, (r.text or "")[:3]) for r in got) == [(0, ""), (0, "thr"), (1, "one"), (2, "two"), (4, "")]
