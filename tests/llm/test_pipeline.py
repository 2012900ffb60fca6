"""The stages of the pipeline, each on its own input."""

import random
from collections import Counter

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402

COLUMNS = corpus_pipeline.COLUMNS


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "123 %%", None, "s", 6), (9003, "", "en", "s", 0)], docs.schema)
    docs = docs.unionByName(extra)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, folder)
        if name != "packing":
            assert result.columns == COLUMNS
            path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}"
            result.write.parquet(path)
            docs = spark.read.parquet(path)
        kept[name] = {r["doc_id"]: r for r in result.collect()}
    assert not {9001, 9002, 9003} & kept["language"].keys() and len(kept["language"]) > 0.98 * len(text)
    plain = {k: " ".join(text[k].split()) for k in kept["language"]}
    assert {min(k for k in plain if plain[k] == t) for t in plain.values()} == set(kept["exact_dedup"])
    assert set(kept["near_dedup"]) <= set(kept["exact_dedup"]) and len(kept["near_dedup"]) > 0.9 * len(kept["exact_dedup"])
    assert kept["suffix_dedup"].keys() == kept["near_dedup"].keys() == kept["packing"].keys()
    assert all(r["n_chars"] == len(r["text"]) for r in kept["suffix_dedup"].values())
    assert all(len(r["text"]) <= len(text[k]) for k, r in kept["suffix_dedup"].items())


def test_repeated_rows_and_null_ids(spark, folder):
    schema = spark.read.parquet(f"{folder}/documents.parquet").schema
    long, other, tail = ("".join(f"{n} {k} word " for k in range(60)) for n in ("one", "two", "three"))
    rows = [(1, long, "en", "s", 0), (1, long, "en", "s", 0), (1, other + tail, "en", "s", 0), (None, tail, "en", "s", 0), (2, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, schema)
    once = corpus_pipeline.drop_exact_copies(spark, docs, folder)
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in once.collect()) == sorted((a or 0, t or "") for a, t, *_ in rows[1:])
    cut = corpus_pipeline.remove_repeated_passages(spark, docs, folder).collect()
    # Both rows of the repeated text are emptied; one document holds another one's text, which is null-keyed.
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in cut) == [(0, ""), (1, ""), (1, ""), (1, other), (2, "")]


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0


def bits(text):
    """The fingerprint of the near-duplicate stage, by the definition."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    found = [xxh64_intdigest(b" ".join(words[k : k + 3]), 42) for k in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def least_of_groups(prints):
    """The places that stay when every pair is looked at; a group keeps its first."""
    group = list(range(len(prints)))
    for k, own in enumerate(prints):
        for j in range(k):
            if group[k] != group[j] and (own ^ prints[j]).bit_count() <= 2:
                low, high = sorted((group[k], group[j]))
                group = [low if g == high else g for g in group]
    return {k for k, g in enumerate(group) if k == g}


def planted():
    """Texts with copies of one to several changed words, a crowd of copies, equal texts, and clean texts."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7)))
    base = [[word() for _ in range(rnd.randint(60, 900))] for _ in range(40)]
    out = [list(b) for b in base]
    for b in base[:30]:
        for changes in (0, 1, 1, 2, 8):
            copy = list(b)
            for _ in range(changes):
                copy[rnd.randrange(len(copy))] = word()
            out.append(copy)
    for _ in range(150):
        copy = list(base[35]) * 4
        copy[rnd.randrange(len(copy))] = word()
        out.append(copy)
    out += [["a", "b"], ["A", "b"], ["a"], ["%"], [], [" "]]
    return [" ".join(words) for words in out]


def test_near_copies_against_all_pairs(spark, folder):
    texts = planted()
    schema = spark.read.parquet(f"{folder}/documents.parquet").schema
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], schema).repartition(3)
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, folder).collect()}
    want = least_of_groups([bits(t) for t in texts])
    assert kept == want and 60 < len(want) < len(texts) - 80
    assert corpus_pipeline.drop_near_copies(spark, docs.limit(0), folder).count() == 0


def test_near_copies_of_repeated_and_null_ids(spark, folder):
    """A near copy takes no other row of its id with it, and goes under the same or a null id as well."""
    schema = spark.read.parquet(f"{folder}/documents.parquet").schema
    one, two, three = (" ".join(f"{name}{k}" for k in range(100)) for name in ("one", "two", "three"))
    near = lambda t: t.upper()  # noqa: E731  the same words to the fingerprint
    rows = [(1, one), (5, near(one)), (5, two), (None, near(two)), (None, three), (None, near(three)), (7, "apart"), (7, "apart"), (8, None), (9, "")]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], schema)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_copies(spark, docs, folder).collect()]
    third = [r for r in kept if (r[1] or "").lower().startswith("three")]
    assert len(third) == 1 and third[0] in rows
    assert sorted([r for r in kept if r not in third], key=str) == sorted([(1, one), (5, two), (7, "apart"), (8, None)], key=str)
    same = spark.createDataFrame([(3, one, "en", "s", 0), (3, near(one), "en", "s", 0)], schema)
    assert corpus_pipeline.drop_near_copies(spark, same, folder).count() == 1


def test_keep_one_carries_any_columns(spark):
    from shelfstream.llm import simhash

    rows = [(1, "a b c", "p", 1, 2), (2, "a B c", "q", 3, 4), (3, "other", "r", 5, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sha string, fp int, id int")
    assert sorted(tuple(r) for r in simhash.keep_one(docs).collect()) == [rows[0], rows[2]]


def test_repeated_passages_against_all_strings(spark, folder):
    """Passages of 51 words, most of them under 400 bytes, are cut wherever they stand; clean documents stay as they are."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(51) for _ in range(12)]
    assert sum(200 <= len(p) < 400 for p in passages) > 8
    texts = [f"{prose(30)} {p} {prose(20)}" for p in passages for _ in range(2)] + [prose(200) for _ in range(10)] + [None, "", "é" * 150]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], spark.read.parquet(f"{folder}/documents.parquet").schema)
    got = {r["doc_id"]: r for r in corpus_pipeline.remove_repeated_passages(spark, docs, folder).collect()}
    data, size = [(t or "").encode() for t in texts], corpus_pipeline.PASSAGE_BYTES
    times = Counter(b[i : i + size] for b in data for i in range(len(b) - size + 1))
    for k, b in enumerate(data):
        gone = {j for i in range(len(b) - size + 1) if times[b[i : i + size]] > 1 for j in range(i, i + size)}
        rest = bytes(c for j, c in enumerate(b) if j not in gone).decode("utf-8", "ignore")
        assert (got[k]["text"] or "") == rest and (got[k]["n_chars"] or 0) == len(rest)
        assert k >= 24 or passages[k // 2] not in rest
        assert k < 24 or k == 36 or rest == (texts[k] or "")


def test_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
