"""The training-text operators against DuckDB SQL or brute force, on small tables and on edge rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_CHECK, SF_SMALL
from vigil.llm import (decontaminate, fm_index, html_text, mixing, near_dedup, personal_data, quality, registry,
                       substring_dedup, text, token_files, toxicity, url_filter)
from vigil.plans.harness import compare, duck

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra int"
LONG = " ".join(f"word{i}" for i in range(20000))
EDGES = [(1, None, "en", "a", 0, 1), (2, "", "en", "a", 0, 1), (3, "  \n\t ", "en", None, 5, 1), (4, "one two three", "en", "a", 13, 1),
         (4, "one two three", "en", "a", 13, 1), (5, LONG, "en", "b", len(LONG), 1), (6, LONG, "en", None, len(LONG), 1),
         (None, "no id here at all", "en", "b", 17, 1), (7, "ONE Two three", "de", "c", 13, 1), (8, "x" * 50000, "de", "c", 50000, 1)]


def edges(spark):
    return spark.createDataFrame(EDGES, DOCS), spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_sql(spark, name):
    ok, msg = compare(registry.QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), registry.ORACLE[name])
    assert ok, msg


OPERATORS = {
    "quality": quality.judge, "near": near_dedup.near_duplicates, "substring": substring_dedup.dedup, "mix": mixing.mix,
    "copies": mixing.copies, "tokens": token_files.tokens, "private": personal_data.find,
    "toxic": lambda d: toxicity.score(d, d.select("doc_id", F.lit(1).alias("toxic"))),
    "clean": lambda d: decontaminate.clean(d, d.select(F.col("doc_id").alias("item_id"), "text")),
    "leaks": lambda d: decontaminate.matches(d, d.select(F.col("doc_id").alias("item_id"), "text")),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_edge_rows_and_empty_tables(spark, name):
    rows, none = edges(spark)
    got = OPERATORS[name](rows).collect()
    if name not in ("copies", "clean", "leaks"):
        assert len(got) == len(EDGES)
    assert OPERATORS[name](none).collect() == []


def test_near_duplicates_defined_results(spark):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(edges(spark)[0]).collect()}
    assert {(1, 0, 1, True), (2, 0, 2, True), (4, 1, 4, True), (7, 1, 4, False), (6, 19996, 5, False), (None, 1, None, True)} <= got


def test_near_duplicate_star_of_many_copies(spark):
    """Copies that are linked to their original only, and large open groups, keep exactly the true components."""
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 120):
        words = list(base)
        for at in rng.choice(150, int(rng.integers(1, 6)), replace=False):
            words[at] = f"e{i}x{at}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in rows)]
    root = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(len(rows)):
                if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
    assert got == dict(enumerate(root))


def test_near_duplicates_of_a_short_text_in_the_upper_bands_only(spark):
    """Short texts fill few registers: a family that meets only in the upper half of the bands is linked, too."""
    tries = (" ".join(f"t{k}x{i}" for i in range(10)) for k in range(5000))
    base = next(t for t in tries if (near_dedup.shingle_set(t) >> np.uint64(63)).all())
    rows = [(0, base), *((i, f"{base} more{i}") for i in range(1, 60))]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: 0 for i in range(60)}


def test_estimate_is_near_jaccard():
    rng = np.random.default_rng(0)
    a = np.unique(rng.integers(0, 2**63, 4000).astype(np.uint64) * np.uint64(2))
    b = np.unique(np.concatenate((a[:3600], rng.integers(0, 2**63, 400).astype(np.uint64) * np.uint64(2))))
    both = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs(near_dedup.estimate(near_dedup.registers(a)[None], near_dedup.registers(b)[None])[0] - both) < 0.15


def test_fm_index_finds_all_repeats():
    rng = np.random.default_rng(0)
    body = rng.integers(1, 4, 400)
    body[[99, 250, 399]] = 0
    starts = np.array([i for i in range(395) if not (body[i:i + 5] == 0).any()])
    found, low = fm_index.FMIndex(body).repeated(body, starts, 5)
    times = Counter(tuple(body[s:s + 5]) for s in starts)
    assert sorted(found) == [s for s in starts if times[tuple(body[s:s + 5])] > 1]
    assert len(set(zip(low, (tuple(body[s:s + 5]) for s in found)))) == len(set(low))


def test_substring_hot_minimizer_gives_the_same(spark, monkeypatch):
    rng = np.random.default_rng(2)
    phrase = " ".join(f"p{i}" for i in range(12))
    rows = [(i, " ".join([*(f"a{rng.integers(3)}" for _ in range(12)), phrase, *(f"b{rng.integers(3)}" for _ in range(12))])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, substring_dedup.dedup(docs).collect()))
    monkeypatch.setattr(substring_dedup, "HOT", 1)
    assert sorted(map(tuple, substring_dedup.dedup(docs).collect())) == want
    seen, brute = set(), []
    for i, t in rows:
        w = t.split()
        gone = set()
        for s in range(len(w) - 19):
            key = tuple(w[s:s + 20])
            if key in seen:
                gone |= set(range(s, s + 20))
            seen.add(key)
        brute.append((i, len(w), len(gone)))
    assert [r[:3] for r in want] == brute


def test_permutation_is_one(spark):
    for n in (1, 2, 7, 1000):
        rows = spark.range(n).select(mixing.swap_or_not(F.col("id"), F.lit(n).cast("long"), [F.lit(3)]).alias("p")).collect()
        assert sorted(r.p for r in rows) == list(range(n))


def test_mix_targets_and_totals(spark):
    got = mixing.query(spark, SF_SMALL).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    size = Counter()
    for r in docs.values():
        size[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(size.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * size[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left -= target[s]
            open_.remove(s)
    taken = Counter()
    for r in got:
        source = docs[r.doc_id].source
        assert r.source_size == size[source] and abs(r.target - target[source]) < 1e-6 * (1 + r.target) and 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    for s in order:
        assert abs(taken[s] - target[s]) <= 0.05 * target[s] + 2 * mixing.BLOCK
    assert sorted((r.doc_id, r.taken) for r in mixing.query(spark, SF_SMALL).collect()) == sorted((r.doc_id, r.taken) for r in got)


def test_token_files_round_trip_and_short_access(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    path = text.scratch(spark, "test-tokens")
    token_files.write(docs, path)
    library = token_files.tokenizer(token_files.TOKENIZER)
    want, start = [], 0
    for r in docs.orderBy("doc_id").collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, token_files.documents(spark, path).collect())) == want
    few = token_files.read(spark, path, [3, 17]).collect()
    assert sorted((r.doc_id, r.ids_crc32) for r in few) == [(want[3][0], want[3][3]), (want[17][0], want[17][3])]


def test_encoder_equals_the_library_on_odd_texts():
    encoder = token_files.Encoder(token_files.TOKENIZER)
    for t in ("", " ", "a  b", "a \n b", "\n\nx", "it's 12² <|endoftext|> _—中", "x ", "\0 y z"):
        ids = encoder.tokenizer.encode(t, add_special_tokens=False).ids
        assert encoder.encode(t) == np.array([*ids, 0], dtype="<u4").tobytes()


def test_texts_encoded_together_equal_the_library_also_when_pieces_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_PIECES", 7)
    encoder = token_files.Encoder(token_files.TOKENIZER, limit=20)
    rng = np.random.default_rng(6)
    for _ in range(8):
        texts = [None, "", "a  b", "x\0y", *(" ".join(f"w{k}" for k in rng.integers(40, size=n)) for n in (0, 1, 3, 30)), " a ", "a\nb c"]
        want = [np.array([*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4").tobytes() for t in texts]
        assert encoder.encode_all(texts) == want


def test_word_hashes_tell_words_apart():
    rng = np.random.default_rng(7)
    words = [bytes(rng.choice(list(b"ab\0\xc3"), size=n).tolist()) for n in rng.integers(1, 20, size=400)] + [b"x" * n for n in range(1, 140)]
    raw = b" \t" + b"\x0b\n ".join(words) + b"\r"
    hashes = text.word_hashes(raw).tolist()
    assert len(hashes) == len(words) and len(set(hashes)) == len(set(words)) == len(set(zip(hashes, words)))
    assert not len(text.word_hashes(b"")) and not len(text.word_hashes(b" \n"))


def test_benchmark_items_are_found_exact_and_edited(spark):
    rng = np.random.default_rng(4)
    word = lambda: f"w{rng.integers(5000)}"
    items = [(i, " ".join(word() for _ in range(40))) for i in range(20)]
    rows = [(100 + i, " ".join([word() for _ in range(60)])) for i in range(20)]
    rows += [(i, " ".join([*(word() for _ in range(30)), t.upper(), *(word() for _ in range(30))])) for i, t in items[:10]]
    edited = [" ".join([*t.split()[:39], "changed"]) for _, t in items]
    rows += [(i, " ".join([*(word() for _ in range(30)), edited[i], word()])) for i in range(10, 20)]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, bench).collect()} == {(i, i) for i in range(20)}
    assert sorted(r.doc_id for r in decontaminate.clean(docs, bench).collect()) == list(range(100, 120))


def test_toxicity_held_out(spark):
    """On the small table (399 labelled rows) the model must beat chance clearly and raise few false alarms."""
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet").select("doc_id", "toxic").dropDuplicates(["doc_id"])
    rows = toxicity.query(spark, SF_CHECK).join(labels, "doc_id").where("held_out").collect()
    toxic, fine = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in fine]) > 0.6
    assert np.mean([s >= 0.5 for s in fine]) < 0.2


def test_toxicity_learns_from_whole_texts(spark):
    """Toxic passages behind the first 4,096 characters are learnt, and long ordinary texts calibrate the threshold."""
    rng = np.random.default_rng(8)
    filler = lambda n: " ".join(f"common{k}" for k in rng.integers(400, size=n))
    bad = " ".join(f"vileword{k}" for k in range(12))
    rows = [(i, " ".join([filler(500), *([bad] * 8 if i % 2 else []), filler(60)])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.score(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))).where("held_out").collect()
    assert np.mean([r.predicted for r in got if r.doc_id % 2]) > 0.9
    assert np.mean([r.predicted for r in got if r.doc_id % 2 == 0]) < 0.2


def test_base_patterns_equal_plain_regexes():
    plain = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                     r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]
    rng = np.random.default_rng(3)
    for _ in range(3000):
        t = "".join(rng.choice(list("a1@.+- (9)0%5"), int(rng.integers(1, 40))))
        want = [(*m.span(), 0) for m in plain[0].finditer(t)]
        want += [(*m.span(), 1) for m in plain[1].finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
        for m in plain[2].finditer(t):
            d = re.sub("[^0-9]", "", m[0])
            if 12 <= len(d) <= 19 and personal_data.luhn(d):
                want.append((*m.span(), 2))
        want += [(*m.span(), 3) for m in plain[3].finditer(t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
        assert personal_data.base_spans(t) == sorted(want)


def test_skip_edges_carry_a_label():
    node = np.zeros((len(personal_data.features("")), 5))
    x = np.zeros((3, len(node)))
    node[1, 1] = 6.0
    x[0, 1] = 1
    none, skip = np.zeros((0, 2), dtype=int), np.array([[0, 2]])
    p = personal_data.marginals(x, none, skip, (node, np.zeros((5, 5)), np.full(5, 4.0)))
    assert p[2, 1] > 0.8 and abs(p[1, 1] - 0.2) < 1e-6


def test_html_extraction_and_differencing(spark):
    page = ("<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><a>menu</a></nav><article><h1>A &amp; B</h1>"
            "<p>one  <b>two</b><br>three<p>four<div class='comments'>no</div></article><footer>f</footer></body>")
    rows = [(1, "http://h/a/1", page), (2, "http://h/b/1", None), (3, None, ""), (3, None, ""),
            (4, "http://x/p1", "<div>site</div><div>first page text here</div><div>end</div>"),
            (5, "http://x/p2", "<div>site</div><div>other text of this page</div><div>end</div>")]
    got = sorted((r.page_id, r.text, r.n_chars) for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)).collect())
    assert got[0] == (1, "A & B\none two three\nfour", 24) and got[1:4] == [(2, "", 0), (3, "", 0), (3, "", 0)]
    assert {t for i, t, _ in got if i > 3} <= {"first page text here", "other text of this page", "site\nfirst page text here\nend", "site\nother text of this page\nend"}
    assert html_text.difference(["s", "long text of a", "e"], ["s", "long text of b", "e"]) == ["long text of a"]
    assert html_text.difference(["s", "same"], ["s", "same"]) == ["s", "same"]  # copies


def test_html_differencing_over_borders_and_of_long_templates(spark):
    """Every page of a host loses its template, however pages are partitioned and however long the template is; copies stay whole."""
    template = "".join(f"<div>line {k} of the long template of this site</div>" for k in range(20))
    rows = [(i, f"http://{h}/p{i:03}", f"{template}<div>own text {i}</div>") for h, ids in (("a", range(40)), ("b", range(40, 43))) for i in ids]
    rows += [(100 + i, f"http://c/p{i}", f"{template}<div>{'the one article' if i < 2 else f'other {i}'}</div>") for i in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {**{i: f"own text {i}" for i in range(43)}, 100: "the one article", 101: "the one article", 102: "other 2", 103: "other 3"}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "8", "60"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            assert {r.page_id: r.text for r in html_text.extract(pages).collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_url_rules_edges(spark):
    urls = [(1, None, 9), (2, "no scheme", 9), (3, "http://WWW.example.COM/en/x?q", 9), (4, "http://a.example.com/en/", 9), (5, "http://x.net/es/1#t", 9),
            (6, "http://x.net", 9), (7, "http://example.com/de/", 9), (7, "http://example.com/de/", 9)]
    pages = spark.createDataFrame(urls, "page_id long, url string, rule int")
    got = sorted((r.page_id, r.rule or "", r.verdict) for r in url_filter.judge(pages, url_filter.rule_table(spark)).collect())
    assert got == [(1, "", "allow"), (2, "", "allow"), (3, "www.example.com/en/", "allow"), (4, "example.com/en/", "block"),
                   (5, "net/es/", "block"), (6, "", "allow"), (7, "com/", "allow"), (7, "com/", "allow")]


def test_frequent_lines_spare_copies(spark):
    line = "this line stands on every page of the site"
    name = lambda n: "".join(chr(97 + int(c)) for c in str(n))  # noqa: E731  digits are all one in normal lines
    body = lambda i: " ".join(f"longerword{name(i)}x{name(k)}" for k in range(60))
    rows = [(i, "h", f"{body(i)}\n{line}") for i in range(40)] + [(100 + i, "h", f"{body(999)}\nand more of the copy") for i in range(40)]
    found = quality.frequent_lines(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    assert [r.line for r in found] == [hashlib.md5(line.encode()).hexdigest()]


def test_frequent_lines_of_long_templates_and_beside_copies(spark):
    """A line in more than 20 different texts is found, whatever share of each text is template or copies."""
    name = lambda n: "".join(chr(97 + int(c)) for c in str(n))
    template = [" ".join(f"templateword{name(k)}x{name(j)}" for j in range(20)) for k in range(10)]
    own = lambda i: " ".join(f"ownlongword{name(i)}x{name(j)}" for j in range(8))
    rows = [(i, "h", "\n".join([*template, own(i)])) for i in range(30)]
    line = "a line that stands in many copies of one text and in other texts"
    rows += [(100 + i, "g", f"{line}\nthe text that is copied") for i in range(200)]
    rows += [(400 + i, "g", f"{line}\n{own(i)}") for i in range(25)]
    rows += [(500 + i, "f", f"{line}\n{own(i)}") for i in range(20)]  # at the limit
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = {(r.host, r.line, r.n_docs) for r in quality.frequent_lines(docs).collect()}
    digest = lambda x: hashlib.md5(x.encode()).hexdigest()
    assert found == {*(("h", digest(x), 30) for x in template), ("g", digest(line), 26)}
    assert not any(r.kept for r in quality.judge(docs).where("source = 'h'").collect())


def test_pipeline_equals_its_stages_by_hand(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = {r.doc_id for r in quality.query(spark, SF_SMALL).collect() if r.kept}
    docs = docs.where(F.col("doc_id").isin(list(kept)))
    near = {r.doc_id for r in near_dedup.near_duplicates(docs).collect() if r.kept}
    docs = docs.where(F.col("doc_id").isin(list(near)))
    leaks = {r.doc_id for r in decontaminate.matches(docs, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).collect()}
    docs = docs.where(~F.col("doc_id").isin([-1, *leaks]))
    want = token_files.tokens(mixing.copies(docs)).orderBy("start").collect()
    assert corpus_pipeline.run(spark, SF_SMALL).orderBy("start").collect() == want
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "benchmark decontamination", "source mixing", "token output"]
