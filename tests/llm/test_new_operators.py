"""Alignment, periodic runs and fingerprints against brute force, with nulls, empty and long texts, ties, repeats and extra columns."""

import hashlib
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from shelfstream.llm import alignment, periodic_runs, queries, sketches  # noqa: E402

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, part int, key string, pack long, pair long, best boolean, n long, w string, follows string"
EXTRA = (1, "k", 2, 3, True, 4, "w", "f")
rnd = random.Random(5)


def prose(words, letters="abcdeéèñ"):
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 8))) for _ in range(words))


LONG = prose(4000)
TEXTS = [
    None, "", " ", "\t\n", "A", "The quick brown fox", LONG, LONG, LONG[:3000], "x" * 900, "日本語" * 300, "  a  b \n  c\x85 d  e  ", "it's <|endoftext|> İ\x1c ß",
    "a▁b", "<s> </s> <unk> <0x41>", prose(60), prose(700, "ab"), "😀 \x00 ́a", "ha " * 50, "one two three " * 30 + prose(40) + " four five" * 20, "end ",
]


def table(spark, texts=TEXTS):
    return spark.createDataFrame([(3 * k + 1, t, *EXTRA) for k, t in enumerate(texts)], SCHEMA).repartition(3)


def saved(spark, df, folder):
    df.write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


# ---- alignment ----------------------------------------------------------------------
def brute_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a_lib, b_lib = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    a_lib.encode_special_tokens = True
    letters = alignment._byte_letters()
    out, links = {}, {}
    for k, t in texts.items():
        whole = (" " + (t or "")).encode()
        a = a_lib.encode(" " + (t or ""), add_special_tokens=False).ids
        b = b_lib.encode(t or "")
        spell_a = [bytes(letters[c] for c in a_lib.id_to_token(i)) for i in a]
        spell_b = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [b_lib.id_to_piece(i)]]
        if not t or b"".join(spell_a) != whole or b"".join(spell_b) != whole:
            out[k], links[k] = (0, 0, 0, ""), []
            continue
        spans = []
        for ids, spelled in ((a, spell_a), (b, spell_b)):
            ends = np.cumsum([len(x) for x in spelled]).tolist()
            spans.append(list(zip([0, *ends[:-1]], ends, ids)))
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = []
        for low, high in zip([0, *cuts[:-1]], cuts):
            groups.append("|".join(",".join(str(i) for s, e, i in own if low <= s and e <= high) for own in spans))
        links[k] = [(x, y) for s, e, x in spans[0] for u, v, y in spans[1] if max(s, u) < min(e, v)]
        out[k] = (len(a), len(b), len(cuts), hashlib.sha256(";".join(groups).encode()).hexdigest())
    counts = Counter(p for own in links.values() for p in own)
    most = {}
    for (x, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    return {
        k: (n_a, n_b, groups, len(links[k]), sum(counts[p] == most[p[1]] for p in links[k]), sum(counts[p] for p in links[k]), sha)
        for k, (n_a, n_b, groups, sha) in out.items()
    }


def test_alignment(spark):
    short = [t if t is None or len(t) < 4000 else t[:4000] for t in TEXTS]
    docs = table(spark, short)
    want = brute_alignment({3 * k + 1: t for k, t in enumerate(short)})
    got = rows(alignment.aligned_documents(docs, BYTE, PIECE))
    assert {k: tuple(r)[1:] for k, r in got.items()} == want
    assert sum(v[0] > 0 for v in want.values()) >= 15 and want[40] == (0, 0, 0, 0, 0, 0, "")
    assert alignment.aligned_documents(docs.limit(0), BYTE, PIECE).count() == 0


def test_alignment_of_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(7, "same text"), (7, "same text"), (None, "same text"), (None, None)], "doc_id long, text string")
    got = sorted(tuple(r)[1:] for r in alignment.aligned_documents(docs, BYTE, PIECE).collect())
    n = got[-1][3]
    assert got[0] == (0, 0, 0, 0, 0, 0, "") and got[1] == got[2] == got[3] and got[1][4:6] == (n, 3 * n)


def test_lanes_give_the_links_of_whole_documents(monkeypatch):
    both = alignment.TokenPair(BYTE, PIECE)
    texts = pa.array([LONG, "", "short text", "x" * 3000, LONG[:777]])
    a, b, n_a, n_b = both.encode(texts)
    ends = np.cumsum(both.a_size[a]), np.cumsum(both.b_size[b])
    results = []
    for size in (8, 1 << 30):
        monkeypatch.setattr(alignment, "LANE_TOKENS", size)
        of_a, of_b, *cuts = alignment.lockstep(*ends, n_a, n_b)
        results.append((sorted(zip(of_a.tolist(), of_b.tolist())), [c.tolist() for c in cuts]))
    assert results[0] == results[1]


@pytest.mark.parametrize("ranked", [True, False])
def test_odd_chunks_are_encoded_like_whole_texts(ranked):
    both = alignment.TokenPair(BYTE, PIECE)
    assert both.a.ranked is not None
    if not ranked:
        both.a.ranked = None
    signs = ["a", "é", " ", " ", "\n", "\t", " ", " ", "\x85", "\x1c", "'s", "1", ".", "日", "the", "\x0b"]
    made = ["".join(rnd.choice(signs) for _ in range(rnd.randint(1, 25))) for _ in range(1500)]
    a, b, n_a, n_b = both.encode(pa.array(made))
    cuts_a, cuts_b = np.cumsum(n_a), np.cumsum(n_b)
    for k, t in enumerate(made):
        assert a[cuts_a[k] - n_a[k] : cuts_a[k]].tolist() == both.a.library.encode(" " + t, add_special_tokens=False).ids, repr(t)
        assert b[cuts_b[k] - n_b[k] : cuts_b[k]].tolist() == both.b.encode(t), repr(t)


# ---- periodic runs ------------------------------------------------------------------
def brute_runs(words, least=24, periods=3):
    found = []
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(least, periods * q):
                own = words[i : i + length]
                if not any(all(own[x] == own[x + d] for x in range(length - d)) for d in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def made_words():
    """Texts of few letters, of runs with every sort of period, broken and overlapping, and of nested runs."""
    out = [[], ["a"], list("ab" * 12), list("a" * 24), list("a" * 23), list(("a" * 10 + "b") * 9)]
    for k in range(60):
        words = []
        while len(words) < 400:
            period = rnd.choice([1, 2, 3, 7, 8, 9, 11, 12, 13, 17, 18, 26, 27, 40, 41, 61, 62, 90])
            base = [rnd.choice("abc" if k % 3 else "abcdefghijkl") for _ in range(period)]
            words += (base * 6)[: rnd.randint(2 * period, 5 * period)]
            words += [rnd.choice("abcdef") for _ in range(rnd.randint(0, 9))]
        out.append(words)
    for period in (3, 8, 12, 18, 27, 41, 62):
        out.append(["z", *[f"w{k}" for k in range(period)] * max(3, -(-24 // period)), "z"])
    out.append((list("abcdefgh") * 4 + list("xyzuvw")) * 5)
    return out


def test_runs_against_all_periods():
    made = made_words()
    lists = pa.array(made, pa.list_(pa.string()))
    want = [brute_runs(w) for w in made]
    assert periodic_runs.runs_of(lists) == want
    assert sum(map(len, want)) > 100 and {q for rows in want for _, _, q in rows} >= {1, 2, 3, 8, 12, 18, 27, 41, 62}
    assert periodic_runs.runs_of(lists, 9, 4) == [brute_runs(w, 9, 4) for w in made]
    assert [periodic_runs.runs_of(pa.array([w], pa.list_(pa.string())))[0] for w in made] == want
    with pytest.raises(ValueError):
        periodic_runs.runs_of(lists, 9, 2)


def test_words_are_split_at_ascii_white_space_only():
    texts = ["", " a\x0bb \x1cc d \r\n", "\t", "x"]
    assert periodic_runs.split_words(pa.array(["skip", *texts]).slice(1)).to_pylist() == [t.encode().split() and [w.decode() for w in t.encode().split()] for t in texts]


def expected_runs(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in ("".join(f"{s},{n},{q}\n" for s, n, q in found), " ".join(w for i, w in enumerate(words) if i not in gone))]
    return (len(found), *best, 1000 * best[1] // best[2] if found else None, *sha)


def test_op12_query(spark, tmp_path):
    texts = [t if t is None or len(t) < 3000 else " ".join(t.split(" ")[:300]) for t in TEXTS] + [" ".join(w) for w in made_words()[:20]]
    data = [(k, t) for k, t in enumerate(texts)] + [(1000 + k, texts[k % len(texts)]) for k in range(300)]
    folder = saved(spark, spark.createDataFrame([(k, t, *EXTRA) for k, t in data], SCHEMA), tmp_path)
    got = rows(queries.op12_periodic_runs(spark, folder))
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in data) > 20
    for k, t in data:
        assert tuple(got[k])[1:] == expected_runs(k, t), (k, t)
    empty = spark.createDataFrame([], SCHEMA)
    assert queries.op12_periodic_runs(spark, saved(spark, empty, tmp_path / "empty")).count() == 0


# ---- fingerprints ---------------------------------------------------------------------
def expected_neighbours(data):
    order = sorted(data, key=lambda r: -r[0])
    return {k: ((t or ""), (order[(i + 1) % len(order)][1] or "")) for i, (k, t) in enumerate(order)}


@pytest.mark.parametrize("tasks", ["3", "8"])
def test_op13_query(spark, tmp_path, tasks):
    texts = [t.replace("\x00", "") if t else t for t in TEXTS] * 8
    data = [(7 * k % 1009 - 300, t) for k, t in enumerate(texts)]
    folder = saved(spark, spark.createDataFrame([(k, t, *EXTRA) for k, t in data], SCHEMA).repartition(5), tmp_path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        got = rows(queries.op13_fingerprints(spark, folder))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == len(data)
    prints = dict(zip((t or "" for _, t in data), map(sketches.to_text, sketches.sketch_many(pa.array([t for _, t in data])))))
    for k, (own, following) in expected_neighbours(data).items():
        edited = own[: len(own) - len(own) // 3] + following[: len(own) // 3]
        row = got[k]
        assert (row["n_chars"], row["edited_sha256"]) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        assert row["fingerprint"] == prints[own]
        (changed,) = sketches.sketch_many(pa.array([edited]))
        assert row["edited_fingerprint"] == sketches.to_text(changed)
        assert row["near_edited"] == sketches.containment(sketches.from_text(prints[own]), changed)
        assert row["near_next"] == sketches.containment(*(sketches.from_text(prints[t]) for t in (own, following)))


def test_op13_repeated_null_and_single_rows(spark, tmp_path):
    one = spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")
    row = sketches.compare_in_order(one).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and row["near_next"] == 1.0
    data = [(5, "aaa"), (5, "aaa"), (None, "bbb"), (None, None), (9, "ccc"), (2, "ddd")]
    got = sorted((r["doc_id"] or 0, r["edited_sha256"]) for r in sketches.compare_in_order(spark.createDataFrame(data, one.schema)).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert len(got) == 6 and (9, sha("cca")) in got and {e for k, e in got if k == 5} == {sha("aaa"), sha("aad")}
    assert {e for k, e in got if k == 0} in ({sha("bb"), sha("")}, {sha("bbc"), sha("")}) and (0, sha("")) in got
    assert sketches.compare_in_order(one.limit(0)).count() == 0


def shingles(text):
    data = text.encode()
    return {data[i : i + sketches.SHINGLE] for i in range(max(1, len(data) - sketches.SHINGLE + 1))} if data else set()


def test_estimates_and_merging():
    texts = ["", "a", "a\x00", "short one", prose(20), prose(3000), prose(900), "é" * 5000]
    texts += [texts[5][: len(texts[5]) // 2], texts[5][:4000] + texts[6], texts[6][:60], texts[4] + texts[4]]
    found = sketches.sketch_many(pa.array(texts))
    for t, own in zip(texts, found, strict=True):
        assert len(own) >= min(len(shingles(t)), sketches.LEAST) and (np.diff(own.astype(object)) > 0).all()
        assert len(shingles(t)) > sketches.LEAST or len(own) == len(shingles(t))
        assert sketches.from_text(sketches.to_text(own)).tolist() == own.tolist()
    for x, a in zip(texts, found, strict=True):
        for y, b in zip(texts, found, strict=True):
            both = sketches.merged(a, b)
            assert both.tolist() == sketches.merged(b, a).tolist()
            one, other = shingles(x), shingles(y)
            if min(len(one), len(other)) > 4000:
                assert abs(sketches.containment(a, b) - len(one & other) / len(one)) < 0.2
            if x == y:
                assert sketches.containment(a, b) == sketches.resemblance(a, b) == 1.0
    half, whole = found[8], found[5]
    assert sketches.containment(half, whole) == 1.0 and abs(sketches.containment(whole, half) - 0.5) < 0.1
    assert abs(sketches.resemblance(half, whole) - 0.5) < 0.1 and sketches.containment(found[5], found[6]) < 0.1
    # A joined text has the merged sketch but for the shingles that span the joint.
    joined = sketches.sketch_many(pa.array([texts[5] + texts[6]]))[0]
    assert len(set(joined.tolist()) ^ set(sketches.merged(found[5], found[6]).tolist())) <= sketches.SHINGLE


def test_fingerprint_columns_and_groups(spark):
    docs = spark.createDataFrame([(1, "x", LONG), (2, "x", LONG), (3, "y", LONG[:9000]), (4, "z", None), (5, "z", "tiny")], "doc_id long, source string, text string")
    prints = docs.withColumn("fingerprint", sketches.fingerprint(F.col("text")))
    pair = prints.alias("a").join(prints.alias("b"), F.expr("a.doc_id = b.doc_id - 1")).select("a.doc_id", sketches.contained(F.col("a.fingerprint"), F.col("b.fingerprint")).alias("c"))
    got = {r["doc_id"]: r["c"] for r in pair.collect()}
    assert got[1] == 1.0 and 0.2 < got[2] < 0.8 and got[3] == got[4] == 0.0
    groups = sketches.group_hashes(prints, "source")
    x, y = ({r["hash"]: r["n"] for r in groups.filter(F.col("source") == g).collect()} for g in "xy")
    assert set(x.values()) == {2} and set(y) <= set(x)
    assert sorted(x) == [f"{h:016x}" for h in sketches.sketch_many(pa.array([LONG]))[0].tolist()]
