"""Exact deduplication, spelling forms and the conversation trie against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from flowtables.llm import conversation_trie, exact_dedup, spelling
from flowtables.llm.suite import CORPUS_QUERIES
from tests.llm import brute
from tests.llm.test_corpus_edges import ODD, frame, prose

FOLDER = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string"


def groups(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=repr)


def wanted_groups(docs):
    found = brute.exact_groups(docs)
    return sorted(((i, *g) for (i, _), g in zip(docs, found)), key=repr)


@pytest.mark.parametrize("capacity", [3, 16, 4096])
@pytest.mark.parametrize("collide", [False, True])
def test_exact_groups(spark, capacity, collide):
    pick = random.Random(5)
    docs = [(i, pick.choice([*ODD, "HOT one", "hot ONE", "hot one", "É", "é", prose(i)])) for i in range(300)]
    docs += [(i, "hot one") for i in range(300, 500)] + [(7, "same"), (7, "same"), (None, "same"), (7, "other")]
    docs += [(None, "no id")] * 5 + [(-5, "Z"), (-9, "z")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    hashed = {"hashed": lambda t: F.xxhash64(F.length(t) % 7)} if collide else {}
    rows = exact_dedup.exact_groups(df, capacity=capacity, **hashed).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr) == (
        wanted_groups(docs)
    )
    stays = [r for r in rows if r.kept]
    assert len(stays) == len({r.text_sha256 for r in rows}) == len({r.text_sha256 for r in stays})
    assert all(r.doc_id == r.keep_id for r in stays)


def test_exact_groups_of_odd_tables(spark):
    df = frame(spark, [*ODD, "a", "A"]).withColumns({c: F.lit("x") for c in ("id", "digest", "group_size")})
    out = exact_dedup.exact_groups(df)
    assert out.count() == len(ODD) + 2 and {"lang", "source", "_row", "id", "digest"} <= set(out.columns)
    assert len(out.columns) == len(set(out.columns))
    empty = exact_dedup.exact_groups(df.where("false"))
    assert empty.count() == 0 and empty.columns == out.columns


def test_buckets_split_and_share_the_directory(spark):
    rows = [(k << 56, 3) for k in range(1, 5)] + [((k << 60) - (1 << 63), 2) for k in range(8)]
    keys = spark.createDataFrame(rows, "key bigint, n bigint").cache()
    slots, depth = exact_dedup.directory(keys, 6)
    found = {r.slot: (r.bucket, r.depth) for r in slots.collect()}
    assert depth > 2 and all(s >> (depth - d) == b for s, (b, d) in found.items())
    held = {}
    for key, n in rows:
        place = found[(key % (1 << 64)) >> (64 - depth)]
        held[place] = held.get(place, 0) + n
    assert max(held.values()) <= 6 and len(held) > 3


def forms(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_spelling_forms_of_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    pick = random.Random(1)
    used = sorted({w for _, t in docs for w in (t or "").split() if len(w) >= 7})
    some = set(pick.sample(used, 3000))
    docs = [(i, " ".join(w for w in (t or "").split() if w in some)) for i, t in docs]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    wanted = brute.spelling_forms(docs)
    assert forms(spelling.spelling_forms(df)) == wanted
    assert any(v[3] for v in wanted.values()) and len(wanted) > 300


def test_spelling_forms_of_planted_edits(spark):
    pick, texts = random.Random(2), []
    for base in ("aabbccdd", "ßeñorÀÿab", "mississippi", "x" * 63, "y" * 64, "z" * 65, "abc" * 40):
        for n, times in ((0, 300), (1, 25), (2, 2)):
            word = base
            for _ in range(n):
                at = pick.randrange(len(word))
                word = word[:at] + pick.choice(["", "q", word[at] + "w", word[at] * 2]) + word[at + 1 :]
            texts += [word.upper() if k % 2 and word.isascii() else word for k in range(times)]
    texts += ["aaaaaaa"] * 30 + ["aaaaaaaa"] * 3 + ["aaaaaaaaa"] * 400 + ["x" * 3000 + "y"] * 2 + ["x" * 3000] * 50
    docs = [(i % 40, w) for i, w in enumerate(texts)] + [(None, "nullish " * 3), (3, None), (4, "")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("word", F.lit(1))
    wanted = brute.spelling_forms(docs)
    assert any(v[1] != k and v[1] != v[0] for k, v in wanted.items())
    assert any(len(k) > 1000 and v[0] for k, v in wanted.items())
    assert forms(spelling.spelling_forms(df)) == wanted
    # fingerprints for nearly all
    assert forms(spelling.spelling_forms(df, long=8)) == wanted


def test_spelling_of_a_table_without_words_and_of_a_very_long_word(spark):
    df = spark.createDataFrame([(1, None), (2, "short")], "doc_id bigint, text string")
    out = spelling.spelling_forms(df)
    assert out.count() == 0 and out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert spelling.spelling_forms(df.where("false")).count() == 0
    long = spark.createDataFrame([(1, "x" * 200_000)] * 3, "doc_id bigint, text string")
    assert spelling.spelling_forms(long).count() == 1


def trie(df):
    names = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    rows = df.collect()
    found = {(r.conv_id, r.depth): tuple(r[c] for c in names) for r in rows}
    assert len(found) == len(rows)
    return found


def test_trie_of_shared_heads(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    wanted = brute.prefix_trie(brute.shared_heads(rows))
    assert trie(CORPUS_QUERIES["op13_conversation_trie"](spark, FOLDER)) == wanted


@pytest.mark.parametrize("width, partitions", [(2, "7"), (1024, "7"), (3, "1")])
def test_trie_over_blocks_and_partitions(spark, width, partitions):
    pick, rows = random.Random(9), []
    for c in range(1, 160):
        base = [pick.choice("ab") * pick.randint(1, 2) for _ in range(pick.randint(0, 5))]
        if c % 3 == 0:
            base = ["hot", "a", "b", "c", "d", "e"][: pick.randint(3, 6)]
        if c % 40 == 1:
            base = ["hot"] * 6
        rows += [(c, i, "user", t) for i, t in enumerate(base)]
    rows += [(500, i, None, "long") for i in range(8)] + [(501, i, None, "long") for i in range(9)]
    rows += [(502, None, "user", None), (502, None, None, "x"), (502, 1, "u", "x"), (None, 1, "u", "x")]
    rows += [(503, 1, "u", "x")] * 3
    df = spark.createDataFrame(rows, TURNS).withColumns({"pos": F.lit(1), "conv": F.lit("x")})
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        turns = conversation_trie.original_turns(df, hot_rows=50)
        plain = brute.shared_heads(rows)
        lent = conversation_trie.with_shared_heads(turns)
        assert trie(conversation_trie.prefix_trie(*lent, width, 50)) == brute.prefix_trie(plain)
        assert trie(conversation_trie.prefix_trie(turns, turns.select("conv").distinct(), width, 50)) == (
            brute.prefix_trie(own_turns(rows))
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def own_turns(rows):
    """Conversations as they are: heads are lent only within a hundred, so ids are spread apart."""
    apart = brute.shared_heads([(None if c is None else c * 100, *r) for c, *r in rows])
    return {c // 100: t for c, t in apart.items()}


def test_trie_of_nothing(spark):
    turns = conversation_trie.original_turns(spark.createDataFrame([], TURNS))
    assert conversation_trie.prefix_trie(*conversation_trie.with_shared_heads(turns)).count() == 0
