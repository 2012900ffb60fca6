"""Each operator against a brute-force version on a small table with nulls, empty and long texts, ties and repeats."""

import hashlib
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from shelfstream.llm import (  # noqa: E402
    components, exact_dedup, html_text, language_id, neighbours, packing, pieces, repeats, simhash, substring_dedup, suffix_dedup, wavelet,
)

SCHEMA = "doc_id long, text string, block string, size long, pack long, node long, raw string"
rnd = random.Random(7)


def prose(words):
    return " ".join("".join(rnd.choice("abcdeéèñ") for _ in range(rnd.randint(1, 8))) for _ in range(words))


def corpus():
    passage, long = prose(120), prose(4000)
    near = long.split(" ")
    near[2000] = "changed"
    texts = [
        None, "", " \t\n", "Aé", long, long, " ".join(near), long.replace(" ", "\n"), passage, prose(30) + " " + passage + " " + prose(20),
        prose(5) + " " + passage, passage + " " + passage, prose(200), "x" * 900, "日本語" * 300, prose(60), "  a  b  ", "it's <|endoftext|> İ\x1cß",
    ]
    return [(k * 3 + 1, t, "other", 1, 2, 3, "raw") for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def keyed(df):
    return {r["doc_id"]: r for r in df.collect()}


def texts():
    return {row[0]: row[1] or "" for row in corpus()}


@pytest.fixture(scope="module", autouse=True)
def same_corpus():
    rnd.seed(7)
    fixed = corpus()
    globals()["corpus"] = lambda: fixed


def test_suffix_dedup(docs, nothing):
    untouched, cut = suffix_dedup.remove_repeats(docs)
    got = keyed(untouched.unionByName(cut))
    data = {k: t.encode() for k, t in texts().items()}
    seen = {}
    for b in data.values():
        for i in range(len(b) - 399):
            seen[b[i : i + 400]] = seen.get(b[i : i + 400], 0) + 1
    assert got.keys() == data.keys()
    for key, b in data.items():
        gone = np.zeros(len(b) + 2, int)
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                gone[i + 1 : i + 401] = 1
        kept = bytes(c for c, g in zip(b, gone[1:-1]) if not g)
        row = got[key]
        assert (row["n_bytes"], row["n_removed"], row["n_spans"]) == (len(b), len(b) - len(kept), int((np.diff(gone) == 1).sum()))
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    for part in suffix_dedup.remove_repeats(nothing):
        assert part.count() == 0


def test_difference_covers():
    for q in (2, 3, 5, 7, 11):
        v, cover = repeats.difference_cover(q)
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))


@pytest.mark.parametrize("size", [1, 2, 300, 100_000])
def test_names_are_sent_whole(size):
    keys = np.unique(np.random.default_rng(size).integers(0, 1 << 64, size, dtype=np.uint64))
    keys[-1] = np.uint64((1 << 64) - 1)
    sent = repeats._sent(keys)
    assert np.array_equal(repeats._received(sent), keys) and (size < 100_000 or len(sent) < 6.7 * size)


def test_substring_dedup(docs, nothing):
    words = {k: re.findall("[^\x20\x09-\x0d]+", t) for k, t in texts().items()}
    first = {}
    for key in sorted(words):
        for i in range(len(words[key]) - 49):
            first.setdefault(tuple(words[key][i : i + 50]), key)
    got = keyed(substring_dedup.remove_repeated_windows(docs))
    for key, own in words.items():
        gone = [False] * len(own)
        for i in range(len(own) - 49):
            if first[tuple(own[i : i + 50])] < key:
                gone[i : i + 50] = [True] * 50
        kept = " ".join(w for w, g in zip(own, gone) if not g)
        assert (got[key]["n_words"], got[key]["n_removed"], got[key]["kept"]) == (len(own), sum(gone), kept)
        assert got[key]["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    assert substring_dedup.remove_repeated_windows(nothing).count() == 0


def test_substring_dedup_in_small_pieces(docs, monkeypatch):
    """Many packs, names compared in blocks and results sent in pieces change nothing."""
    whole = keyed(substring_dedup.remove_repeated_windows(docs))
    for module, name, value in ((repeats, "PACK_BYTES", 3000), (repeats, "HASH_BLOCK", 64), (substring_dedup, "SENT_BYTES", 100)):
        monkeypatch.setattr(module, name, value)
    assert keyed(substring_dedup.remove_repeated_windows(docs)) == whole


def test_packs_lie_in_small_row_groups(spark, monkeypatch):
    """A writer looks at its buffers at every pack, so what a reader decodes at a time doesn't grow with a task's input."""
    monkeypatch.setattr(repeats, "PACK_BYTES", 20_000)
    monkeypatch.setattr(repeats, "ROW_GROUP_BYTES", 50_000, raising=False)
    given = spark.createDataFrame([(k, prose(3000)) for k in range(60)], "doc_id long, text string").coalesce(1)
    packs, size, path = repeats.write_packs(given, "text", "doc_id")
    files = [pq.ParquetFile(f) for f in Path(path).glob("*.parquet")]
    groups = [f.metadata.row_group(k) for f in files for k in range(f.num_row_groups)]
    assert sum(g.num_rows for g in groups) == packs.count() > 40 and size > 900_000
    assert max(g.num_rows for g in groups) <= 12


def test_words_of_a_pack_take_little_memory(monkeypatch):
    data = [prose(100).encode() for _ in range(2000)]
    pack = repeats.Pack({"docs": list(range(2000)), "lengths": [len(t) for t in data], "data": b"".join(data)})
    tracemalloc.start()
    words = substring_dedup.Words(pack)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 14 * len(pack.data)
    spans = list(zip(words.first.tolist(), words.last.tolist(), strict=True))
    assert [bytes(pack.data[a:b]) for a, b in spans] == [w for t in data for w in t.split(b" ")]
    at = np.arange(0, len(words.first) - 50, 3)
    names = words.names(at, 50)
    for module in (repeats, substring_dedup):
        monkeypatch.setattr(module, "HASH_BLOCK", 70)
    again = substring_dedup.Words(pack)
    assert np.array_equal(again.keys, words.keys) and np.array_equal(again.names(at, 50), names)


def test_words_are_joined_by_one_blank():
    text = b"  ab\t c\n\nde \xc3\xa9 f "
    spans = [m.span() for m in re.finditer(rb"[^ \t\n]+", text)]
    for chosen in range(1 << len(spans)):
        own = [s for k, s in enumerate(spans) if chosen >> k & 1]
        first, last = (np.array([s[k] for s in own], np.int32) for k in (0, 1))
        assert substring_dedup._joined_words(np.frombuffer(text, np.uint8), first, last) == b" ".join(text[a:b] for a, b in own)


def test_exact_dedup(docs, nothing):
    plain = {k: re.sub("[\x20\x09-\x0d]+", " ", t) for k, t in texts().items()}
    got = keyed(exact_dedup.exact_dedup(docs, ["doc_id", "text", "block"]))
    for key, norm in plain.items():
        group = [k for k, n in plain.items() if n == norm]
        row = got[key]
        assert (row["keep_id"], row["group_size"], row["kept"]) == (min(group), len(group), key == min(group))
        assert row["text_sha256"] == hashlib.sha256(norm.encode()).hexdigest() and row["block"] == "other"
    assert exact_dedup.exact_dedup(nothing, ["doc_id"]).count() == 0


def test_exact_dedup_repeated_and_null_ids(spark):
    rows = spark.createDataFrame([(5, "a"), (5, "a"), (None, "a"), (None, "b"), (5, "c" * 5000), (5, "c" * 4999 + "d")], "doc_id long, text string")
    got = sorted((r["keep_id"] or 0, r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(rows, ["doc_id"]).collect())
    assert got == [(0, 1, True), (5, 1, True), (5, 1, True), (5, 3, False), (5, 3, True), (5, 3, True)]


def test_simhash(docs, nothing):
    from xxhash import xxh64_intdigest

    prints = {}
    for key, t in texts().items():
        w = t.encode().lower().split()
        h = [xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        prints[key] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    got = keyed(simhash.simhash_groups(docs))
    for key in prints:
        reached = {key}
        while more := {k for k in prints for r in reached if (prints[k] ^ prints[r]).bit_count() <= 2} - reached:
            reached |= more
        assert (int(got[key]["fingerprint"], 16), got[key]["component_id"]) == (prints[key], min(reached))
    assert simhash.simhash_groups(nothing).count() == 0


def test_crowded_points_are_refined(spark):
    """Fingerprints on a chain and in a dense ball: the same components as by looking at all pairs."""
    centre = 0x5A5A_1234_0F0F_7777
    fps = [centre] + [centre ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)][:300] + [0xFFFF << 8 * k for k in range(3)]
    fps = list(dict.fromkeys(fps))
    nodes = spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, id long")
    roots = {r["node"]: r["root"] for r in components.components(simhash.links(nodes)).collect()}
    for i, f in enumerate(fps):
        reached, todo = {i}, [i]
        while todo:
            j = todo.pop()
            new = {k for k, g in enumerate(fps) if (g ^ fps[j]).bit_count() <= 2} - reached
            reached |= new
            todo += new
        assert roots.get(i, i) == min(reached)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)], "node long, to long")
    got = {r["node"]: r["root"] for r in components.components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_language_id(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet").withColumn("held_out", language_id.held_out(F.col("doc_id")))
    model = language_id.train(table.filter("not held_out"))
    found = language_id.predict(table.filter("held_out"), model).select("lang", "prediction.*").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.97 and all(0 <= r["score"] <= 1 for r in found)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 %"), (4, "e" * 1_200_000)], "doc_id long, text string")
    got = [r["lang_pred"] for r in language_id.predict(odd, model).select("doc_id", "prediction.lang_pred").orderBy("doc_id").collect()]
    assert got[:3] == ["und"] * 3 and got[3] in model.languages
    assert [zlib.crc32(b"17") % 4 == 2] == [r[0] for r in spark.range(1).select(language_id.held_out(F.lit(17))).collect()]


def test_language_id_keeps_rare_languages(spark):
    """Beyond the sample's bound a language of few rows is learned in full, and copies of a text are drawn one by one."""
    rows = [(k, f"{k % 1000} " + "der die das " * 3, "de") for k in range(6000)] + [(9000 + k, f"{k} og ikke jeg", "no") for k in range(12)]
    rows += [(20_000 + k, "le la les " * 3, "fr") for k in range(4000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sizes = {"de": 6000, "no": 12, "fr": 4000}
    assert language_id.quota(sizes, 600) == 294 and language_id.quota(sizes, 9000) == 4988 and language_id.quota(sizes, 20_000) >= 6000
    model = language_id.train(table, max_docs=600)
    alone = language_id.train(table.filter("lang = 'no'"))
    assert np.array_equal(model.log_prob[:, model.languages.index("no")], alone.log_prob[:, 0])
    # The share of a text's copies shows in the least probability: smoothing over the counted n-grams of about 294 rows.
    rows_used = ((0.1 / np.exp(model.log_prob[:, model.languages.index("fr")].min().astype(float))) - 0.1 * language_id.BUCKETS) / (29 + 28)
    assert 200 < rows_used < 400
    got = language_id.predict(spark.createDataFrame([(1, "jeg ikke og")], "doc_id long, text string"), model).first()
    assert got["prediction"]["lang_pred"] == "no" and np.allclose(np.exp(model.prior).sum(), 1)


def test_language_id_learns_nothing(spark, nothing):
    model = language_id.train(nothing.withColumn("lang", F.lit("en")))
    row = language_id.predict(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), model).select("prediction.*").first()
    assert tuple(row) == ("und", 0.0)


def test_token_files(spark, docs, nothing):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = wavelet.token_files(docs, path).orderBy("doc_id").collect()
    library, start = wavelet.tokenizer(path).library, 0
    for row, (key, text) in zip(got, sorted(texts().items()), strict=True):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        assert tuple(row) == (key, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert wavelet.token_files(nothing, path).count() == 0


def test_token_files_answer_without_decoding(spark, tmp_path):
    """Shards of 50 ids, null and repeated ids and a document longer than a shard: counts, occurrences and ids by position."""
    path, file = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "shards")
    texts = [(None, "the null one"), (3, "the third"), (3, "third again the"), (9, "the long one " * 60), (5, None), (7, "")] + [(k, f"plain {k} the") for k in range(20, 60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    wavelet.write_tokens(docs.repartition(3), file, path, shard_tokens=50)
    rows = wavelet.read_tokens(spark, file, with_ids=True).orderBy("start").collect()
    assert sorted(repr(r["doc_id"]) for r in rows) == sorted(repr(k) for k, _ in texts) and rows[0]["doc_id"] is None
    assert spark.read.parquet(file).count() > 4
    whole = [(r["doc_id"], k, int(t)) for r in rows for k, t in enumerate(np.frombuffer(r["ids"], "<u4"))]
    library = wavelet.tokenizer(path).library
    the, long = (library.encode(w, add_special_tokens=False).ids[0] for w in ("the", "long"))
    counted = {r["token"]: r["n"] for r in wavelet.count_tokens(spark, file, [the, long, 1, 49_000, the]).collect()}
    assert counted == {t: sum(x == t for _, _, x in whole) for t in (the, long, 1, 49_000)}
    found = wavelet.find_tokens(spark, file, [the, long, 49_000]).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr((t, d, k)) for d, k, t in whole if t in (the, long))
    asked = [0, 1, 49, 50, 51, 200, len(whole) - 1, len(whole), -1]
    assert {(r["position"], r["token"]) for r in wavelet.tokens_at(spark, file, asked).collect()} == {(p, whole[p][2]) for p in asked[:-2]}


def test_words_are_encoded_as_by_the_library():
    import pyarrow as pa

    encoder = wavelet.tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    signs = [*"abcehintABÄÖßÿ ×÷ \n\t.,'é日執1<0x>%́😀\x00²Œſİ\x1c\x85\xa0\xad|{}~-&", "  ", "the", "ing", "<|endoftext|>", "'s", "'ll", "1234", "ǅ"]
    made = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    expected = [found.ids for found in encoder.library.encode_batch(made, add_special_tokens=False)]
    assert [x.tolist() for x in encoder.encode_many(pa.array(made))] == expected


def test_token_files_of_another_tokenizer():
    """A file that states another normalizer or pattern goes through the library whole."""
    import pyarrow as pa

    other = wavelet.WordTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    made = ["The Plain Text", " it's  1234\n", "", None, "Ünï\x1ccode"]
    expected = [other.library.encode(t or "", add_special_tokens=False).ids for t in made]
    assert not other.by_words and [x.tolist() for x in other.encode_many(pa.array(made))] == expected
    assert wavelet.tokenizer(public_tokenizers.path("word_bpe_49k.json")).by_words


@pytest.mark.parametrize("ids", [[7], [5, 5, 5], list(range(70)), [rnd.randrange(300) ** 2 for _ in range(3000)]])
def test_wavelet_matrix(ids):
    matrix = wavelet.WaveletMatrix.build(np.array(ids))
    assert matrix.to_ids().tolist() == ids
    for at in range(0, len(ids), 37):
        assert matrix.access(at) == ids[at] and matrix.rank(ids[at], at) == ids[:at].count(ids[at])
        assert matrix.select(ids[at], ids[:at].count(ids[at])) == at
        assert matrix.positions(ids[at]).tolist() == [k for k, x in enumerate(ids) if x == ids[at]]
    assert matrix.rank(999_999, len(ids)) == 0 and matrix.select(ids[0], len(ids)) == -1


def test_sentencepiece(docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = keyed(pieces.encode_pieces(docs, path, decode=True).select("doc_id", "pieces.*"))
    library = pieces.encoder(path).library
    for key, text in texts().items():
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(got[key]["ids"], "<u4").tolist() == ids and got[key]["decoded"] == library.decode(ids)


def test_sentencepiece_on_odd_texts():
    import pyarrow as pa

    enc = pieces.encoder(public_tokenizers.path("piece_bpe_32k.model"))
    signs = [*"abcehint ▁\n.,'éß日執1<0x>%́😀\x00²", "  ", "    ", "the", "ing"]
    made = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 40))) for _ in range(1500)] + [" " * n + "執" for n in range(40)]
    assert [x.tolist() for x in enc.encode_many(pa.array(made))] == [enc.library.encode(t) for t in made]


def test_nearest_neighbours(spark):
    values = np.random.default_rng(3).normal(size=(900, 16))
    values[100:400] = values[7]  # a third of the rows are one vector
    rows = [(i, v.tolist()) for i, v in enumerate(values)] + [(1000, None), (1100, [0.0] * 16), (1200, [float("nan")] + [1.0] * 15), (1300, [None] * 16)]
    usable = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    single = values.astype(np.float32).astype(float)
    found = {}
    for r in neighbours.nearest(usable, usable.filter("vec_id % 100 = 0")).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(found) == list(range(0, 900, 100))
    hits = 0
    for query, got in found.items():
        distance = np.sqrt(((single - single[query]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(900), distance)) if i != query][:10]
        assert [g[0] for g in sorted(got)] == list(range(1, 11))
        assert all(abs(distance[i] - s) < 1e-12 for _, i, s in got)
        hits += len({g[1] for g in got} & set(order))
    assert hits >= 0.9 * 10 * len(found)
    assert neighbours.nearest(usable.limit(0), usable.limit(0)).count() == 0


def test_html_extraction(spark):
    page = (
        '<html><head><title>no</title><script>var t="</p>";</script></head><body><header>Site</header><nav><a href=x>Home</a></nav>'
        '<div class="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1><p>First<b> para</b>\n graph.<p>Short.</p>'
        '<div class="ad">Buy now</div><p>Second &lt;b&gt; &eacute; one.</p><section id="comments"><p>A reader says a lot of things here</p></section>'
        "</article><aside>Side</aside><footer>&copy; all</footer></body></html>"
    )
    rows = spark.createDataFrame([(1, page), (2, None), (3, ""), (4, "<nav>only</nav>"), (5, "<p"), (6, page)], "page_id long, html string")
    got = {r["page_id"]: r["text"] for r in html_text.extract(rows).collect()}
    assert got[1] == got[6] == "Head & line\nFirst para graph.\nShort.\nSecond <b> é one."
    assert got[2] == got[3] == got[4] == ""


PARAGRAPHS = ["The first paragraph is long enough to be the text of a page and has no link in it at all.",
              "The second one goes on about the same matter, and is as long as the first one was before it.",
              "A third one ends the article, which is no longer than it has to be to be seen as one here."]
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
FRAME = '<html><body><nav><a href="/">Home</a></nav>{}<footer>All rights kept by us since the start</footer></body></html>'


@pytest.mark.parametrize("page", [
    f'<div class="has-sidebar"><article><h1>Head line</h1>{BODY}</article></div>',
    f'<div class="page no-sidebar"><h1>Head line</h1>{BODY}</div>',
    f'<div class="content-with-header"><main><h1>Head line</h1>{BODY}</main></div>',
    f'<div class="layout-sidebar-left"><article><h1>Head line</h1>{BODY}</article></div>',
    f'<form id="form1"><main><h1>Head line</h1>{BODY}</main></form>',
    f'<article><header class="entry-header"><h1>Head line</h1></header>{BODY}</article>',
    f'<article><a name="s1"/><h1>Head line</h1><a id="x">{BODY}</article>',
    '<article><h1>Head line</h1>' + BODY.replace("</p>", ' <a href="/p"></p>', 1) + "</article>",
    f'<article><h1>Head line</h1><a href="/p"/>{BODY}</article>',
])
def test_html_wrappers_and_anchors(page):
    """Names of a wrapper do not hide the article, headlines stay, and only links with a target count."""
    found = html_text.main_text(FRAME.format(page), html_text.trained()).split("\n")
    assert found == ["Head line", *PARAGRAPHS]


@pytest.mark.parametrize("page", [
    f'<article><h1>Head line</h1>{BODY}</article><div class="related-posts"><article>{BODY}</article></div>',
    f'<article><h1>Head line</h1>{BODY}</article><div class="site-footer">{BODY}</div>',
    f'<article><h1>Head line</h1>{BODY}<aside class="ad"><article>{BODY}</article></aside></article>',
    f'<article><h1>Head line</h1>{BODY}</article><div class="comments"><article>{BODY}</article></div>',
    f'<article><h1>Head line</h1>{BODY}<a href=/p/><div>A card as one link</div></a></article>',
])
def test_html_outside_stays_outside(page):
    found = html_text.main_text(FRAME.format(page), html_text.trained()).split("\n")
    assert found == ["Head line", *PARAGRAPHS]


@pytest.mark.parametrize("page", [
    f'<div class="legal"><article><h1>Head line</h1>{BODY}</article></div>',
    f'<div class="tags"><main><h1>Head line</h1>{BODY}</main></div>',
    f'<div id="search"><article><h1>Head line</h1>{BODY}</article></div>',
    f'<div class="sidebar"><main><h1>Head line</h1>{BODY}</main></div>',
    f'<article><h1 id="search">Head line</h1>{BODY}</article>',
    f'<article><h1>Head line</h1>{BODY}<section class="reactions"><p>A reader says a lot of things here.</p></section></article>',
    f'<article><h1>Head line</h1>{BODY}<section id="kommentare"><p>A reader says a lot of things here.</p></section></article>',
    f'<article><h1>Head line</h1>{BODY}</article><div class="user-reviews"><p>A reader says a lot of things here.</p></div>',
    f'<div class="comments"><article>A reader says a lot</article></div><div class="legal"><article><h1>Head line</h1>{BODY}</article></div>',
    f'<h1>Head line</h1>{BODY}',
])
@pytest.mark.parametrize("frame", [FRAME, "{}", '<body><ul><li><a href="/">Home</a><li><a href="/n">The news</a></ul>{}'])
def test_html_article_in_named_wrappers(page, frame):
    """With a footer and without, with a menu that is a plain list of links and without."""
    found = html_text.main_text(frame.format(page), html_text.trained()).split("\n")
    assert found == ["Head line", *PARAGRAPHS]


@pytest.mark.parametrize("blocks", [
    ["A text of one paragraph and no more than that."],
    ["Head line", "By Ann", *PARAGRAPHS],
    ["Head line", "Ann", "A short page without an article element has this one paragraph."],
    ["A longer head line of the page", "Ann Other", PARAGRAPHS[0], "The end."],
])
@pytest.mark.parametrize("wrap", ["{}", "<article>{}</article>", '<ul><li><a href="/">Home</a><li><a href="/n">News</a></ul><div>{}</div>'])
def test_html_short_pages(blocks, wrap):
    """No block is lost for standing last, alone or beside a short one."""
    head, *rest = blocks
    page = wrap.format((f"<h1>{head}</h1>" if rest else f"<p>{head}</p>") + "".join(f"<p>{b}</p>" for b in rest))
    assert html_text.main_text(page, html_text.trained()).split("\n") == blocks


def test_html_paragraph_that_is_a_link():
    page = f'<article><h1>Head line</h1>{BODY}<p><a href="/x">One linked paragraph</a></p>{BODY}</article>'
    found = html_text.main_text(page, html_text.trained()).split("\n")
    assert found == ["Head line", *PARAGRAPHS, "One linked paragraph", *PARAGRAPHS]


def layouts(seed):
    """Pages of drawn layouts without a name the operator knows: (html, blocks of the article, other blocks)."""
    draw = random.Random(seed)
    sentence = lambda low, high: " ".join(draw.choice("on ran light was told seven green house and never").capitalize() if not i else
                                          "".join(draw.choices("abcdefghijk", k=draw.randint(2, 8))) for i in range(draw.randint(low, high)))
    for _ in range(120):
        content, other, html = [], [], ""

        def links(tag, count):
            made = ""
            for _ in range(count):
                text = sentence(1, 5)
                other.append(text)
                made += f"<{tag}><a href='/{len(text)}'>{text}</a></{tag}>"
            return made

        def block(tag, low, high, share):
            words = sentence(low, high).split()
            content.append(" ".join(words))
            cut = int(len(words) * share)
            return f"<{tag}>" + (f'<a href="/y">{" ".join(words[:cut])}</a> ' if cut else "") + " ".join(words[cut:]) + f"</{tag}>"

        html += links(draw.choice(["li", "div", "td"]), draw.randint(2, 9)) if draw.random() < 0.8 else ""
        body = block("h1", 3, 12, 0)
        body += block("p", 1, 3, 0) if draw.random() < 0.4 else ""
        for _ in range(draw.randint(1, 9)):
            body += block("h2", 2, 6, 0) + block("p", 12, 80, 0.1) if draw.random() < 0.2 else block("p", 6, 90, draw.choice([0, 0, 0.1, 0.2]))
        html += draw.choice(["<article>{}</article>", "<main>{}</main>", "<div>{}</div>", "<section><div>{}</div></section>"]).format(body)
        html += links(draw.choice(["li", "p", "td"]), draw.randint(2, 9)) if draw.random() < 0.6 else ""
        yield f"<html><body>{html}</body></html>", content, other


@pytest.mark.parametrize("seed", [5, 100, 101])
def test_html_recall_on_drawn_layouts(seed):
    """At least 0.99 of the article's blocks and at most 0.03 of the others are taken; labels were adjusted on seed 5 only."""
    tree, kept, content, taken, other = html_text.trained(), 0, 0, 0, 0
    for html, inside, outside in layouts(seed):
        found = Counter(html_text.main_text(html, tree).split("\n"))
        kept, content = kept + (found & Counter(inside)).total(), content + len(inside)
        taken, other = taken + (found - Counter(inside)).total(), other + len(outside)
    assert kept >= 0.99 * content and taken <= 0.03 * other


@pytest.mark.parametrize("html", [
    "<i ' " * 200_000, '<a b="> c=" ' * 80_000, "<svg>" * 200_000, "<div>" * 100_000 + "</nav>" * 100_000, "<a " + "=" * 900_000 + "/>x",
    "&#" + "9" * 900_000 + ";", "<a x=\" " * 100_001 + "<b y='>" * 1000, "<!--" * 200_000, "<" * 900_000, "<a href='x>" * 80_000,
])
def test_html_long_odd_pages(html):
    """A megabyte of unclosed quotes, elements or references takes time with its length, not with its square."""
    started = time.monotonic()
    html_text.main_text(html, html_text.trained())
    assert time.monotonic() - started < 5


def test_html_table_cases(spark):
    """An empty table gives none; a text column is replaced, other columns stay, repeated rows give equal rows."""
    rows = spark.createDataFrame([(1, "<p>One text here", "old"), (1, "<p>One text here", "old"), (None, "&#65;&#0000066;", None)], "page_id long, html string, text string")
    assert html_text.extract(rows.limit(0)).count() == 0
    got = html_text.extract(rows).collect()
    assert [tuple(r) for r in got] == [(1, "<p>One text here", "One text here")] * 2 + [(None, "&#65;&#0000066;", "AB")]


def test_decision_tree_on_its_table():
    tree = html_text.trained()
    for page in html_text.LABELLED:
        rows = html_text._features([b[:4] for b in page])
        assert (tree.predict(rows) == [b[4] for b in page]).mean() >= 0.9


def test_packing(spark, nothing):
    lengths = [rnd.randint(1, 9000) for _ in range(500)] + [70_000, 32_768, 32_769, 0, -1, None]
    rows = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, n_tokens long")
    got = packing.pack_documents(rows, shard_pieces=200).collect()
    parts, bins = {}, {}
    for r in got:
        parts.setdefault(r["doc_id"], []).append((r["piece_start"], r["n_tokens"]))
        bins.setdefault((r["shard"], r["bin"], r["capacity"]), []).append((r["bin_start"], r["n_tokens"]))
    for key, whole in enumerate(lengths):
        at = 0
        for start, size in sorted(parts.get(key, [])):
            assert start == at
            at += size
        assert at == max(whole or 0, 0)
    for (_, _, capacity), held in bins.items():
        at = 0
        for start, size in sorted(held):
            assert start == at
            at += size
        assert at <= capacity and capacity == min(c for c in packing.CAPACITIES if c >= at)
    assert packing.pack_documents(packing.byte_lengths(nothing)).count() == 0


def test_packing_fits_best():
    bins, starts, capacity = packing.pack(np.array([600, 500, 400, 300, 200]), (1000,))
    assert bins.tolist() == [0, 1, 0, 1, 1] and starts.tolist() == [0, 0, 600, 500, 800] and set(capacity.tolist()) == {1000}


def test_packing_splits_repeated_rows(spark):
    """Rows of one id and length, null ids included, are dealt to all shards."""
    rows = spark.createDataFrame([(7, 900)] * 600 + [(None, 500)] * 400, "doc_id long, n_tokens long").repartition(4)
    got = packing.pack_documents(rows, shard_pieces=100).collect()
    assert len(got) == 1000 and max(Counter(r["shard"] for r in got).values()) < 200
    assert packing.pack_documents(rows.withColumn("salt", F.lit("x")).withColumn("shard", F.lit(1))).count() == 1000


def thue_morse(letters):
    return "".join(letters[bin(k).count("1") % 2] for k in range(128))


def test_texts_that_steer_sums_of_powers(spark):
    """Two strings of one polynomial modulo 2^64 for every odd base: no string of 400 bytes and no window of words repeats."""
    one, two = (thue_morse("ab"[::d]) + thue_morse("cd"[::d]) + thue_morse("ef"[::d]) + "x" * 16 for d in (1, -1))
    assert one != two and len(one) == 400
    rows = spark.createDataFrame(list(enumerate([one, two, one[5:395], two[5:395]])), "doc_id long, text string")
    untouched, cut = suffix_dedup.remove_repeats(rows)
    assert {r["doc_id"]: r["n_removed"] for r in untouched.unionByName(cut).collect()} == {0: 0, 1: 0, 2: 0, 3: 0}
    spaced = rows.withColumn("text", F.regexp_replace("text", "(.)", "$1 "))
    assert {r["n_removed"] for r in substring_dedup.remove_repeated_windows(spaced, window=400).collect()} == {0}
    long_words = spark.createDataFrame([(k, " ".join([t] * 50)) for k, t in enumerate([one, two])], rows.schema)
    assert {r["n_removed"] for r in substring_dedup.remove_repeated_windows(long_words).collect()} == {0}


def test_names_depend_on_the_content_alone():
    data = np.frombuffer(b"abcabcabd" * 40 + b"the words the word them", np.uint8)
    for length in (3, 7, 8, 9, 16, 31, 133):
        starts = np.arange(len(data) - length + 1)
        keys, seen = repeats.byte_keys(data, starts, length), {}
        for s, k in zip(starts.tolist(), keys.tolist()):
            assert seen.setdefault(bytes(data[s : s + length]), k) == k
        assert len(set(seen.values())) == len(seen)
    first, last = np.array([0, 3, 6, 0, 9, 360, 370]), np.array([3, 6, 9, 20, 29, 363, 373])
    keys = repeats.word_keys(data, first, last).tolist()
    assert keys[0] == keys[1] != keys[2] and keys[3] == keys[4] and keys[5] == keys[6] and len(set(keys)) == 4
