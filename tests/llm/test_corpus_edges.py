"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import random
import textwrap
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowtables.llm import (
    chat_format,
    decontaminate,
    language_id,
    license_scan,
    line_dedup,
    mixing,
    near_dup,
    quality_model,
    quality_rules,
    template,
    url_filter,
)
from flowtables.llm import words as words_module
from flowtables.llm.components import components
from tests.llm import brute

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed, n=120):
    pick = random.Random(seed)
    return " ".join(pick.choice("abcdefghij") * pick.randint(1, 6) + str(seed) for _ in range(n))


def frame(spark, texts, extra=True, lang="en"):
    """Documents 0, 1, ... with the given texts, and columns named like the operators' own."""
    rows = [(i, t, lang, f"s{i % 3}" if i % 5 else None, None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in ("size", "score", "taken", "kept", "root", "key", "n", "doc", "_row", "_source"):
            df = df.withColumn(name, F.lit("x"))
    return df


ODD = [None, "", " \t\n", "word", "a b c d", "é ñ\u2003ü", "1 2 3 4 5 6", "x" * 700_000, "one\r\ntwo\x0bthree"]


def each_row_once(df, n):
    got = df.collect()
    assert sorted(r.doc_id for r in got) == list(range(n))
    return {r.doc_id: r for r in got}


def test_words_of_any_text():
    texts = [*ODD, prose(1), prose(1), "tail ", "y " * 400_000]
    hashes, counts = words_module.hash_words(pa.array(texts), fold=False)
    assert counts.tolist() == [len(brute.words(t)) for t in texts]
    flat = [w for t in texts for w in brute.words(t)]
    same = {}
    for w, h in zip(flat, hashes.tolist()):
        assert same.setdefault(w, h) == h
    assert len(set(same.values())) == len(same)
    values, sizes = words_module.shingle_sets(pa.array(texts))
    assert sizes.tolist() == [len(brute.shingle_set(t)) for t in texts] and len(values) == sizes.sum()


def test_sketches_fill_and_estimate():
    left, right = np.arange(1000, dtype=np.uint64), np.arange(250, 1250, dtype=np.uint64)
    sets = np.concatenate([left, right, left[:1], left[:0]])
    cells = near_dup.sketches(words_module.mix(sets), np.array([1000, 1000, 1, 0]))
    assert (cells[:3] != near_dup.EMPTY).all() and (cells[3] == near_dup.EMPTY).all()
    assert abs((cells[0] == cells[1]).mean() - 0.6) < 0.1


def near_texts():
    """A hot group whose members differ from each other, pairs around the threshold, copies."""
    pick, base = random.Random(3), prose(7, 100).split()
    texts = list(ODD)
    for _ in range(60):
        copy = list(base)
        for _ in range(pick.randint(0, 2)):
            copy[pick.randrange(len(copy))] = f"z{pick.random()}"
        texts.append(" ".join(copy))
    return [*texts, *[prose(9)] * 4, prose(9).upper(), prose(10), "a b c d", "A B  C d", "word"]


@pytest.mark.parametrize("block", [1 << 18, 4000])
def test_near_groups_of_a_hot_group(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK_BYTES", block)
    texts = near_texts()
    wanted = brute.near_groups(dict(enumerate(texts)), 85)
    got = each_row_once(near_dup.near_dup_groups(frame(spark, texts)), len(texts))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == wanted
    assert len({w[1] for w in wanted.values()}) < len(texts) - 20


def test_near_groups_without_ids_and_of_repeated_rows(spark):
    rows = [(None, "u v w x y z"), (5, "u v w x y z"), (5, "u v w x y z"), (None, "q"), (None, None)]
    got = near_dup.near_dup_groups(spark.createDataFrame(rows, "doc_id bigint, text string"))
    found = sorted(map(str, got.select("doc_id", "component_id").collect()))
    assert found == sorted(
        [
            "Row(doc_id=None, component_id=5)",
            "Row(doc_id=5, component_id=5)",
            "Row(doc_id=5, component_id=5)",
            "Row(doc_id=None, component_id=None)",
            "Row(doc_id=None, component_id=None)",
        ]
    )
    assert near_dup.near_dup_groups(got.limit(0).withColumn("text", F.lit("t"))).count() == 0


def test_near_groups_of_sets_whose_ids_repeat_or_are_missing(spark):
    def near(seed, change):
        words = prose(seed, 100).split()
        words[50] = change
        return " ".join(words)

    rows = [
        (5, near(20, "a")), (1, near(20, "b")),  # one text of 5 is near 1, the other near 2
        (5, near(21, "a")), (2, near(21, "b")), (2, near(21, "b")),
        (7, near(22, "a")), (7, near(22, "b")),  # two near texts of one id
        (None, near(23, "a")), (None, near(23, "b")), (None, near(23, "b")),
        (None, near(20, "c")), (8, near(24, "a")), (None, None), (None, ""), (9, ""), (9, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    # the plain version has a number of its own for every row
    plain = brute.near_groups(dict(enumerate(t for _, t in rows)), 85)
    names = {}
    for i, (_, root, _) in plain.items():
        names.setdefault(root, []).append(rows[i][0])
    names = {r: min((d for d in ds if d is not None), default=None) for r, ds in names.items()}
    got = near_dup.near_dup_groups(docs).collect()
    assert sorted(map(str, [(r.doc_id, r.n_shingles, r.component_id) for r in got])) == sorted(
        str((rows[i][0], n, names[root])) for i, (n, root, _) in plain.items()
    )
    kept = sorted(r.doc_id for r in got if r.kept and r.n_shingles and r.doc_id is not None)
    assert kept == [1, 2, 2, 7, 8]
    left = near_dup.drop_near_dups(docs.withColumn("node", F.lit("x"))).collect()
    assert sorted(str(r.doc_id) for r in left) == ["1", "2", "7", "8", "9", "None", "None", "None"]
    assert {r.text for r in left} <= {t for _, t in rows}
    assert sum(r.text in (near(23, "a"), near(23, "b")) for r in left) == 1


def test_components_of_chains_and_loops(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(50, 50), (60, 61), (61, 60), (None, 3), (70, None)]
    found = components(spark.createDataFrame(pairs, "a int, b int"), "a", "b").collect()
    assert {r.node: r.root for r in found} == {**{i: 0 for i in range(41)}, 60: 60, 61: 60}
    assert len(found) == 43


def test_language_of_odd_texts(spark):
    texts = [*ODD, "the of and the", "der die das und", "der", "\U00010400"]
    docs = frame(spark, texts).withColumn("lang_pred", F.lit(1))
    train = spark.createDataFrame(
        [("the of and that", "en"), ("der die und das", "de"), (None, "fr"), ("x", None)],
        "text string, lang string",
    )
    model = language_id.train(train)
    assert model[0] == ["de", "en"]
    got = each_row_once(language_id.identify(docs, model), len(texts))
    assert [got[i].lang_pred for i in (0, 1, 2, 6)] == ["und"] * 4 and got[0].score == 0
    assert [got[len(ODD) + i].lang_pred for i in range(3)] == ["en", "de", "de"]
    assert got[len(texts) - 1].lang_pred in model[0] and got[4].lang_pred in model[0]
    nothing = language_id.train(train.limit(0))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50, 10**6])
def test_pieces_have_the_ngrams_of_the_whole(size):
    for text in ["Ab", "a1b é", "", "q" * 51, "Ünder the  bridge, 12 times. " * 5]:
        whole = language_id.plain(text)
        parts = list(language_id.pieces(whole, size))
        found, counts = language_id.grams(parts, size)
        wanted, n = language_id.grams([whole])
        assert sorted(found) == sorted(wanted) and counts.sum() == n.sum() == len(wanted)
        assert len(wanted) == sum(max(len(whole) - k + 1, 0) for k in language_id.ORDERS)


def test_language_of_a_text_in_pieces(spark, monkeypatch):
    model = (["a", "b"], np.log(np.random.default_rng(1).random((language_id.BUCKETS, 2))).astype("f4"))
    docs = frame(spark, ["short one", prose(3, 3000), "the end", prose(4, 10)])
    whole = language_id.identify(docs, model).select("doc_id", "lang_pred").collect()
    monkeypatch.setattr(language_id, "CHARS", 4000)
    assert language_id.identify(docs, model).select("doc_id", "lang_pred").collect() == whole


def test_quality_rules_of_odd_texts(spark):
    again = "a b c d e f g h " * 3
    texts = [*ODD, again, again + prose(2, 100), "line one\nline one\n\n \nline one ", *map(prose, range(12))]
    docs = frame(spark, texts).withColumn("classes", F.lit(1))
    rows = [{"doc_id": i, "text": t, "lang": "en"} for i, t in enumerate(texts)]
    wanted = {r["doc_id"]: r for r in brute.quality_rules(rows)}
    got = each_row_once(quality_rules.judge(docs), len(texts))
    assert {i: {k: r[k] for k in wanted[i]} for i, r in got.items()} == wanted
    assert got[len(ODD)].base_failed and got[len(ODD)].n_repeat_words == 24
    assert quality_rules.judge(docs.limit(0)).count() == 0
    assert quality_rules.judge(docs.withColumn("lang", F.lit(None).cast("string"))).count() == len(texts)


def test_quality_model_of_odd_texts(spark):
    good = [(prose(i, 60), 1) for i in range(30)]
    bad = [(prose(i, 60).upper().replace(" ", "!! "), 0) for i in range(30)]
    known = [*good, *bad, (None, 1), ("x", None), ("", 0)]
    train = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(known)], "doc_id bigint, text string")
    labels = spark.createDataFrame(
        [(i, q) for i, (_, q) in enumerate(known)] + [(None, 1), (10**6, 0), (0, 1)], "doc_id bigint, quality int"
    )
    model = quality_model.train(train, labels)
    texts = [*ODD, prose(77, 60), prose(78, 60).upper().replace(" ", "!! ")]
    docs = frame(spark, texts)
    got = each_row_once(quality_model.classify(docs, model), len(texts))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert got[0].score == got[1].score and got[len(ODD)].score > 0.5 > got[len(ODD) + 1].score
    empty = quality_model.train(train, labels.limit(0))
    assert {r.score for r in quality_model.classify(docs, empty).collect()} == {0.5}
    assert quality_model.classify(docs.limit(0), model).count() == 0
    assert b"".join(quality_model.chunks(b"x" * 1500)) == b"x" * 1500


def test_mixing_with_ties_and_odd_sources(spark):
    texts = [*ODD, *["a b c"] * 20, *map(prose, range(20))]
    docs = frame(spark, texts)
    got = each_row_once(mixing.mix_sources(docs), len(texts))
    again = mixing.mix_sources(docs.repartition(5)).select("doc_id", "taken").collect()
    assert {r.doc_id: r.taken for r in again} == {i: r.taken for i, r in got.items()}
    assert got[0].taken == got[0]["size"] == 0 and all(r.taken <= 3 * r["size"] for r in got.values())
    for source in {r.source for r in got.values()}:
        mine = [r for r in got.values() if r.source == source]
        assert sum(r.taken for r in mine) == int(mine[0].target)
        assert mine[0].source_size == sum(r["size"] for r in mine)
    targets = {r.source: r.target for r in got.values()}
    assert sum(targets.values()) == pytest.approx(sum(r["size"] for r in got.values()))
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    assert mixing.mix_sources(docs.where("n_chars = 1 or doc_id < 3")).select("taken").distinct().count() == 1
    twice = mixing.mix_sources(docs.unionAll(docs))
    assert twice.count() == 2 * len(texts)


@pytest.mark.parametrize("total", [[9, 1, 1], [0, 0, 5], [1, 100, 1000, 3], [7], [5, 5, 5, 5, 5, 5]])
def test_targets_by_resharing(spark, total):
    sources = spark.createDataFrame([(f"s{i}", n) for i, n in enumerate(total)], "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(sources).collect()}
    weights, target, capped = [1 + i % 3 for i in range(len(total))], {}, set()
    while True:
        rest = sum(total) - sum(3 * total[i] for i in capped)
        loose = [i for i in range(len(total)) if i not in capped]
        target = {i: rest * weights[i] / sum(weights[j] for j in loose) for i in loose}
        over = {i for i in loose if target[i] > 3 * total[i]}
        if not over:
            break
        capped |= over
    target |= {i: 3 * total[i] for i in capped}
    assert got == pytest.approx({f"s{i}": t for i, t in target.items()})


def test_contamination_of_odd_texts(spark):
    items = [prose(50, 30), prose(51, 200), "one two three", None, "", prose(50, 30), prose(52, 7)]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id bigint, text string")
    cut = prose(51, 200).split()
    texts = [
        *ODD,
        prose(1, 5000) + " " + prose(50, 30).upper() + " " + prose(2, 5000),
        prose(3) + "\n" + " ".join(cut[:170]),
        prose(3) + " " + " ".join(cut[:100]),
        "One two THREE",
        prose(52, 7) + "\t" + prose(4),
    ]
    docs = frame(spark, texts)
    wanted = brute.contaminated(dict(enumerate(texts)), dict(enumerate(items)))
    for held in (decontaminate.HELD, 40):
        got = decontaminate.contaminations(docs, bench, held=held).collect()
        assert {(r.doc_id, r.item_id) for r in got} == wanted and len(got) == len(wanted)
        clean = decontaminate.drop_contaminated(docs, bench, held=held)
        assert clean.columns == docs.columns
        assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in wanted}
    assert decontaminate.contaminations(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminations(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("n", [1, 63, 64, 65, 1000])
def test_sketches_of_long_items_in_slices(monkeypatch, n):
    values = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64))
    seeds = words_module.keys(decontaminate.HASHES, 53)
    whole = words_module.mix(values[:, None] ^ seeds)
    monkeypatch.setattr(decontaminate, "SLICE", 64)
    low, where = decontaminate.sketch(values, seeds)
    assert (low == whole.min(axis=0)).all() and (where == values[whole.argmin(axis=0)]).all()
    assert (decontaminate.least(values, seeds) == low).all()


def test_a_very_long_test_item(spark):
    item, other = prose(70, 30_000), prose(71, 30_000)
    bench = spark.createDataFrame([(0, item)], "item_id bigint, text string")
    texts = [f"{prose(1, 300)} {item} {prose(2, 300)}", f"{prose(3)} {' '.join(item.split()[:27_000])}", other]
    got = decontaminate.contaminations(frame(spark, texts), bench).collect()
    assert {r.doc_id for r in got} == {0, 1}


def test_near_pairs_at_the_pipelines_threshold(spark):
    n, texts = 3000, []
    for i in range(n):
        words = [f"w{i}x{k}" for k in range(49)]  # 40 of 50 shingles are shared
        texts += [" ".join(words), " ".join([*words[:44], *(f"v{i}x{k}" for k in range(5))])]
    got = near_dup.near_dup_groups(frame(spark, texts, extra=False), corpus_pipeline.NEAR_PERCENT)
    assert got.where("kept").count() == n
    assert near_dup.banding(85) == (32, 8) and near_dup.banding(80) == (42, 6)


def test_licences_in_odd_texts(spark):
    mit = "Released under the MIT License."
    texts = [*ODD, mit, f"{prose(1)}\n{mit}\n{prose(2)}", f"{prose(3)}. {mit} {prose(4)}", "mit licens",
             license_scan.TEMPLATES[2][1], mit + "\nAll rights reserved.", "released_under THE mit-license"]
    got = each_row_once(license_scan.scan(frame(spark, texts).withColumn("licenses", F.lit(0))), len(texts))
    names = [[x.name for x in got[i].licenses] for i in range(len(texts))]
    n = len(ODD)
    assert names[:n] == [[]] * n and names[n + 3] == []
    assert names[n][0] == names[n + 1][0] == names[n + 2][0] == names[n + 6][0] == "mit"
    assert names[n + 4] == ["apache-2.0"] and set(names[n + 5]) == {"mit", "all-rights-reserved"}
    assert license_scan.scan(frame(spark, texts), []).where("size(licenses) > 0").count() == 0


def best_dice(text, template, threshold=80):
    """Best Dice coefficient over all windows of at most (2 - t) / t times the template's length."""
    words, want = license_scan.plain_words(text), license_scan.plain_words(template)
    said, held = list(zip(words, words[1:])), set(zip(want, want[1:]))
    reach, best = max((len(want) - 1) * (200 - threshold) // threshold, 1), 0.0
    for i in range(len(said)):
        seen = set()
        for pair in said[i : i + reach]:
            seen.add(pair)
            best = max(best, 2.0 * len(seen & held) / (len(seen) + len(held)))
    return best


def wrapped(text, mark="", width=60):
    return "\n".join(mark + x for x in textwrap.wrap(text, width))


def test_wrapped_licences_in_long_documents(spark):
    long = {}
    for name, text in license_scan.LONG_TEMPLATES:
        long.setdefault(name, text)
    short = [t for n, t in license_scan.TEMPLATES if n == "apache-2.0"][1]
    notices = [
        ("mit", wrapped(long["mit"])),
        ("apache-2.0", wrapped(short, "// ")),
        ("bsd", wrapped(long["bsd"], " * ").replace("COPYRIGHT HOLDERS", "REGENTS")),
        ("gpl-3.0", wrapped([t for n, t in license_scan.LONG_TEMPLATES if n == "gpl-3.0"][1], "# ")),
        ("gpl-2.0", wrapped([t for n, t in license_scan.LONG_TEMPLATES if n == "gpl-2.0"][1])),
        ("mit", f"{prose(5, 30)} released under\nthe MIT license {prose(6, 30)}"),
    ]
    texts = [f"{prose(i, 1500)}\n\n{t}\n\n{prose(100 + i, 1500)}" for i, (_, t) in enumerate(notices)]
    texts += [f"{prose(1)} permission is granted to nobody, the software license says {prose(2)}"]
    got = each_row_once(license_scan.scan(frame(spark, texts)), len(texts))
    assert [got[i].licenses[0].name for i in range(len(notices))] == [n for n, _ in notices]
    assert got[len(notices)].licenses == []


def test_windows_by_brute_force(spark):
    pick = random.Random(3)
    templates = [("x", "red blue red green and gold of red blue mist"), ("y", "gold of mist green tin"), ("z", "tin red")]
    words = "red blue green and gold of mist tin".split()
    texts = ["\n".join(pick.choice(words) for _ in range(pick.randint(1, 60))) for _ in range(60)]
    for i in range(60):
        run = templates[i % 2][1].split()
        run.insert(pick.randint(0, len(run)), pick.choice(words))
        texts.append(f"{texts[i]} {' '.join(run)} {texts[59 - i]}")
    got = each_row_once(license_scan.scan(frame(spark, texts), templates), len(texts))
    for i, text in enumerate(texts):
        dice = {n: best_dice(text, t) for n, t in templates}
        wanted = sorted(((-d, n) for n, d in dice.items() if 100 * d >= 80))
        assert [(-x.dice, x.name) for x in got[i].licenses] == wanted


def test_a_text_full_of_licences(spark):
    """20,000 words of worn licence texts take no longer than a scan of so many words; a minute is ample."""
    pick = random.Random(9)
    texts = [t for _, t in (*license_scan.TEMPLATES, *license_scan.LONG_TEMPLATES)]
    said = []
    while len(said) < 20_000:
        run = pick.choice(texts).split()
        run[pick.randrange(len(run))] = "zebra"
        said += run
    began = time.monotonic()
    got = each_row_once(license_scan.scan(frame(spark, [" ".join(said)])), 1)
    assert time.monotonic() - began < 60
    assert {x.name for x in got[0].licenses} >= {"mit", "apache-2.0", "gpl-3.0", "bsd", "mpl-2.0"}


def test_anchors_are_needed():
    pick = random.Random(5)
    for _, text in license_scan.TEMPLATES:
        pairs = license_scan.pairs(license_scan.plain_words(text))
        held = set(license_scan.anchors(pairs))
        for _ in range(200):
            kept = [p for p in pairs if pick.random() < 0.9]
            if 2 * len(kept) / (len(pairs) + len(kept)) >= 0.8:
                assert held & {w for p in kept for w in p.split()}


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_chats_of_odd_turns(spark):
    text = r"\[/INST] <\\s></s>[OUT][TURN]x[NAME] é\n"
    rows = [
        (1, 2, "assistant", text), (1, 1, "user", text), (1, 0, None, None), (1, 3, "to[NAME]ol", text),
        (None, None, "user", "a"), (None, 1, "user", ""), (2, 0, "assistant", None), (3, 1, "user", "b"),
        (3, 1, "user", "a"), (3, 1, "user", "a"),
    ]
    for part in (chat_format.PART, 30):
        made = chat_format.format_conversations(turns(spark, rows).withColumn("part", F.lit(1)), part=part)
        got = {r.conv_id: r for r in chat_format.digests(made).collect()}
        assert {k: r.n_turns for k, r in got.items()} == {1: 4, None: 2, 2: 1, 3: 3}
        import hashlib

        said = f"\n\nuser\n{text}\nassistant\n{text}\nto[NAME]ol\n{text}\n"
        assert got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert got[1].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert got[1].loss_chars == len(text) and got[3].loss_chars == got[2].loss_chars == 0
        three = hashlib.sha256(b"user\na\nuser\na\nuser\nb\n").hexdigest()
        assert got[3].turns_sha256 == three
    assert chat_format.digests(chat_format.format_conversations(turns(spark, rows).limit(0))).count() == 0


def test_templates():
    run = lambda source, *texts: list(
        template.compiled(source)([{"role": "user", "text": t} for t in texts])
    )
    assert run("a{{ 'b' + 'c' | upper }}d") == [("abCd", False)]
    loop = "{% for m in messages %}{{ m.text }}{% if not loop.last %},{% endif %}{% endfor %}"
    assert "".join(t for t, _ in run(loop, "x", "y", "z")) == "x,y,z"
    marks = "{% for m in messages %}{% generation %}{{ m.text }}{% endgeneration %}{% endfor %}"
    assert run(marks, "x") == [("x", True)]
    dead = template.folded(template.parse("{% if 1 == 2 %}a{% elif 'x' != 'y' %}b{% else %}c{% endif %}d"))
    assert dead == (template.Output(template.Const("bd")),)
    for wrong in ("{{ m.text.upper }}", "{{ x | system }}", "{% for %}", "{% if 1 %}", "{{ 1", "{{ }}", "{% x %}",
                  "{% endfor %}", "{{ __import__('os') }}"):
        with pytest.raises(template.TemplateError):
            list(template.compiled(wrong + " {{ nothing }}")([]))
    for text in ("", "[<\\", "\\[\\<", "a[\\b\\\\[", "</s>[INST]"):
        assert template.unescape(template.escape(text)) == text
        assert "[INST]" not in template.escape(text) and "</s>" not in template.escape(text)


def test_urls_and_equivalence(spark):
    def page(i, url, html=""):
        return (i, url, html)

    pages = spark.createDataFrame(
        [
            page(0, None), page(1, "no scheme"), page(2, "http://A.Example.ORG?x"), page(3, "x://org"),
            page(4, "http://bad.net/x#y", "<link href='https://alias.info/a' rel=\"canonical\">"),
            page(5, "http://alias.info/a", '<meta http-equiv="refresh" content="0; url=/b">'),
            page(6, "https://alias.info/b"), page(7, "http://good.bad.net/x", "<link rel=canonical href=//far.info/>"),
            page(8, "http://far.info", "<link rel=canonical href=http://bad.net/x>"), page(9, "http://bad.netx/"),
            page(10, "http://bad.net/x#y", None), page(11, "http://far.info/other"),
        ],
        "page_id bigint, url string, html string",
    )
    rules = spark.createDataFrame(
        [("bad.net", "/", "block"), ("org", "/", "allow")], "host string, path string, verdict string"
    )
    allow = rules.unionAll(spark.createDataFrame([("good.bad.net", "/", "allow")], rules.schema))
    got = {r.page_id: r for r in url_filter.filter_urls(pages.withColumn("rule", F.lit(1)), rules).collect()}
    assert len(got) == 12 and (got[0].host, got[0].path, got[0].rule, got[0].verdict) == ("", "", None, "allow")
    assert (got[2].host, got[2].path, got[3].host) == ("a.example.org", "", "org")
    assert {i for i, r in got.items() if r.verdict == "block"} == {4, 5, 6, 7, 8, 10}
    assert got[4].rule == "bad.net/" and got[5].rule is None
    got = {r.page_id: r for r in url_filter.filter_urls(pages, allow).collect()}
    assert {i for i, r in got.items() if r.verdict == "block"} == {4, 10}
    assert got[7].rule == "good.bad.net/"
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0
    assert url_filter.filter_urls(pages, rules.limit(0)).where("verdict = 'block'").count() == 0


def test_addresses_of_one_page_are_one_node(spark):
    same = [
        ("http://a.net/x/y", "../z?b=1&amp;c=2", "a.net/z?b=1&c=2"),
        ("http://a.net/x/y", "./z", "a.net/x/z"), ("http://a.net/x/y", "../../../z/.", "a.net/z/"),
        ("http://a.net/x/", "..", "a.net/"), ("http://a.net", ".hidden/..a", "a.net/.hidden/..a"),
        ("http://A.net:80/x", "https:&#x2F;&sol;B.net:443", "b.net/"), ("https://a.net/x", "//b.net:80/y", "b.net:80/y"),
        ("http://a.net/x", "&amp;#47;", "a.net/&"),
    ]
    df = spark.createDataFrame(same, "url string, target string, wanted string")
    target = url_filter.unescaped(F.col("target"))
    got = df.select("wanted", url_filter.address(url_filter.resolved(F.col("url"), target)).alias("got"))
    assert [r.got for r in got.collect()] == [w for _, _, w in same]
    assert df.select(url_filter.address(F.lit(None).cast("string"))).distinct().first()[0] is None
    pages = spark.createDataFrame(
        [
            (1, "http://a.net/x/y", "<link rel='canonical' href='../z?b=1&amp;c=2'>"),
            (2, "http://a.net:80/x/../z?b=1&c=2", ""),
            (3, "http://c.net/p", "<base href='http://a.net/x/'><link rel=canonical href=y>"),
            (4, "http://c.net/x/y", ""),
        ],
        "page_id bigint, url string, html string",
    )
    rules = spark.createDataFrame([("c.net", "/p", "block")], "host string, path string, verdict string")
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(pages, rules).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow"}


def test_mix_with_more_ranges_and_without_ids(spark, monkeypatch):
    texts = [" ".join(["w"] * (i % 9)) + f" t{i}" for i in range(300)]
    docs = spark.createDataFrame(
        [(i if i % 2 else None, t, "hot" if i % 3 else None) for i, t in enumerate(texts)],
        "doc_id bigint, text string, source string",
    )
    assert [mixing._digits(n) for n in (None, 0, 2 * 10**6 * 4096, 2 * 10**6 * 4096 + 1, 10**15)] == [3, 3, 3, 4, 5]
    few = sorted(map(str, mixing.mix_sources(docs).collect()))
    monkeypatch.setattr(mixing, "RANGE_WORDS", 0)
    assert sorted(map(str, mixing.mix_sources(docs).collect())) == few
    for r in mixing.mix_sources(docs).groupBy("source").agg(F.sum("taken").alias("n"), F.max("target").alias("t")).collect():
        assert abs(r.n - r.t) < 1


def test_lines_of_odd_texts(spark):
    row = "user {} logged in from {} today"
    texts = [*ODD, *[row.format(f"u{i}", i) + f"\n{prose(i)}" for i in range(6)],
             *[f"the value of {w} is set to none here\n{prose(20 + i)}" for i, w in enumerate("kmpqrs")],
             *["same line of five words\nsame line of five words\nshort"] * 4, prose(60), prose(60)]
    docs = frame(spark, texts).withColumn("kept_text", F.lit(1))
    dropped = brute.recurring_lines(dict(enumerate(texts)))
    got = each_row_once(line_dedup.dedup_lines(docs), len(texts))
    for i, text in enumerate(texts):
        kept = None if text is None else "\n".join(
            x for k, x in enumerate(text.split("\n")) if (i, k) not in dropped
        )
        assert got[i].kept_text == kept
        assert got[i].n_lines == (0 if text is None else text.count("\n") + 1)
    # the last text is a long line of two documents
    assert {i for i, _ in dropped} == {*range(10, 15), *range(16, 21), *range(22, 25), 26}
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0
    twice = docs.where("doc_id between 9 and 14")
    assert line_dedup.dedup_lines(twice.unionAll(twice)).where("n_dropped > 0").count() == 10


def test_long_lines_of_two_documents_and_very_many_lines(spark):
    passage, almost = prose(70, 60), prose(71, 49)
    many = "\n".join(f"{prose(i, 6)} end" for i in range(3000))
    texts = [f"{prose(1)}\n{passage}\n{almost}", f"{almost}\n{passage}\n{prose(2)}", many, f"{many}\n{prose(3)}"]
    docs = frame(spark, texts)
    got = each_row_once(line_dedup.dedup_lines(docs), len(texts))
    dropped = brute.recurring_lines(dict(enumerate(texts)))
    for i, text in enumerate(texts):
        assert got[i].kept_text == "\n".join(x for k, x in enumerate(text.split("\n")) if (i, k) not in dropped)
    assert dropped == {(1, 1)} and got[1].kept_text == f"{almost}\n{prose(2)}"
    huge = "\n".join(f"{i % 977} some words of a line {'x' * (i % 5)}" for i in range(100_000))
    big = frame(spark, [huge, huge + "\nlast", huge])
    counts = {r.doc_id: (r.n_lines, r.n_dropped) for r in line_dedup.dedup_lines(big).collect()}
    assert counts == {0: (100_000, 0), 1: (100_001, 100_000), 2: (100_000, 100_000)}


def test_lines_that_share_leading_words_stay(spark):
    ends = ["are for", "of rest", "ing ere", "oues aha", "the enre"]
    six = ["very old dogs", "new red cars", "some good wine", "many tall trees", "few small boats"]
    shared = ["the dog", "the cat", "the sea", "the sun", "the end"]
    logs = "job number {} of queue {} ended with state {} after {} seconds"
    texts = [
        "\n".join(
            [
                f"was erlytion that {ends[i]}",
                f"here we have {six[i]}",
                f"once upon a {shared[i]}",
                logs.format(i, "main", 3 * i, 7 * i),
                f"please note that the office of {'abcde'[i]}x is closed on all public holidays",
                prose(i),
            ]
        )
        for i in range(5)
    ]
    got = each_row_once(line_dedup.dedup_lines(frame(spark, texts)), len(texts))
    assert got[0].kept_text == texts[0]
    for i in range(1, 5):
        lines = texts[i].split("\n")
        assert got[i].kept_text == "\n".join(lines[:3] + lines[5:])


def test_pipeline_of_odd_tables(spark, tmp_path):
    for name, df in (
        ("labels", spark.createDataFrame([], "doc_id bigint, quality int, toxic int")),
        ("benchmark", spark.createDataFrame([(0, prose(50, 30))], "item_id bigint, text string")),
    ):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    texts = [*ODD, prose(50, 40), prose(1), prose(1)]
    docs = frame(spark, texts, extra=False)
    clashing = docs.withColumns(
        {
            c: F.lit("x")
            for c in ("extra", "score", "predicted", "_good", "_bad", "_row", "_gone", "_lines", "row", "gone",
                      "whole", "kept_text", "n_lines", "mark", "doc", "wanted", "leaf", "a b")
        }
    )
    for table in (docs, docs.limit(0), clashing):
        now = table
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            now = stage(spark, now, str(tmp_path))
            assert number == 4 or now.columns == table.columns
        if "score" in table.columns:
            assert {tuple(r) for r in now.select("score", "predicted", "_row", "kept_text", "a b").collect()} == {("x",) * 5}
        left = {r.doc_id for r in now.collect()}
        assert left <= set(range(len(texts))) - {len(texts) - 3, len(texts) - 1, 0, 1, 2}
