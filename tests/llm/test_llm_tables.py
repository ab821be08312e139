"""Near copies, repeated passages, search, language, mixing, preferences and the pipeline, compared with brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter
from fractions import Fraction
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tempora.llm import bag_minhash, suffix_groups
from tempora.llm.bag_minhash import near_duplicates, shingles, signatures
from tempora.llm import byte_cnn
from tempora.llm.byte_cnn import ByteNet, fit_language, identify_language, least_score, predict_language
from tempora.llm.common import BATCH_BYTES, BATCH_SETTING, give_back, hashed_ranks
from tempora.llm.pfair_mix import deal, mix_sources, one_period, schedule, whole_shares
from tempora.llm.preference import format_pairs, neighbour_pairs
from tempora.llm.queries import vocabulary_path
from tempora.llm.segment_bpe import encode_decode
from tempora.llm.suffix_groups import remove_repeats, suffix_array
from tempora.llm.topk_histogram import top_k

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def bag(text):
    words = [w for w in (text or "").encode().split()]
    if not words:
        return None
    return Counter([tuple(words)] if len(words) < 5 else [tuple(words[i : i + 5]) for i in range(len(words) - 4)])


def classes(rows):
    bags, parent = {i: bag(t) for i, t in rows if i is not None}, {i: i for i, _ in rows}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sorted(bags), 2):
        if bags[a] and bags[b]:
            both = sum((bags[a] & bags[b]).values())
            if 100 * both >= 80 * (sum(bags[a].values()) + sum(bags[b].values()) - both):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i: top(i) for i in bags}


def near_copies(rng, groups, size, words, edits):
    out = []
    for _ in range(groups):
        base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(edits)):
                copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
            out.append(" ".join(copy))
    return out


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(1)
    for few in (5, 10**6):
        base = [str(rng.randint(0, few)) for _ in range(300)]
        other = ["x" if rng.random() < 0.03 else w for w in base]
        keys, weights = shingles([" ".join(base).encode(), " ".join(other).encode()])
        a, b = signatures(keys, weights, 2, 4096)
        x, y = bag(" ".join(base)), bag(" ".join(other))
        both = sum((x & y).values())
        assert abs((a == b).mean() - both / (sum(x.values()) + sum(y.values()) - both)) < 0.04
        assert weights.max() > 1 or few > 5


def test_classes_of_near_copies_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(bag_minhash, "FULL_BUCKET", 3)  # so that pivots come into play
    rng = random.Random(7)
    texts = near_copies(rng, 12, 12, 120, 9) + ["short text", "short text", "short  text", "a b c d e", "a b c d f", "", " \n", None, "same " * 400, "same " * 400, "same " * 330]
    rng.shuffle(texts)
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + [(None, "short text"), rows[0]], "doc_id long, text string").withColumn("node", F.lit("clash")).withColumn("class_id", F.lit(0))
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows) + 2 and [r["class_id"] for r in got if r["doc_id"] is None] == [None]
    assert {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] is not None} == classes(rows)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_bounded_pairs_lose_no_link(spark, monkeypatch):
    """One bucket-filling group around the limit, many of them below it to all others: pivots, bounds and further rounds."""
    monkeypatch.setattr(bag_minhash, "FULL_BUCKET", 2)
    rng = random.Random(11)
    rows = list(enumerate(near_copies(rng, 2, 60, 100, 12)))
    monkeypatch.setattr(bag_minhash, "DEVIATIONS", 40)  # registers rule out nothing: what is left out is left out by bounds
    rounds = []
    real = bag_minhash.candidates
    monkeypatch.setattr(bag_minhash, "candidates", lambda live, no, percent: rounds.append("shared" in live.columns) or real(live, no, percent))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), bands=40, rows=4).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == classes(rows)
    assert any(rounds) and len(set(classes(rows).values())) > 2


def test_shared_counts_bound_every_overlap(spark):
    rng = random.Random(3)
    rows = list(enumerate([*near_copies(rng, 1, 12, 60, 9), "one two three", "same " * 40, "same " * 30]))
    found = {r["node"]: r for r in bag_minhash.shared_counts(spark.createDataFrame(rows, "node long, text string")).collect()}
    bags = {i: bag(t) for i, t in rows}
    for i, b in bags.items():
        others = set().union(*[set(x) for j, x in bags.items() if j != i])
        assert found[i]["total"] == sum(b.values()) and sum(found[i]["shared"]) == sum(n for w, n in b.items() if w in others)
    for i, j in itertools.combinations(bags, 2):
        assert sum(map(min, found[i]["shared"], found[j]["shared"])) >= sum((bags[i] & bags[j]).values())


def removed(rows, window=200):
    counts = Counter()
    raw = [(t or "").encode() for _, t in rows]
    for r in raw:
        counts.update(r[i : i + window] for i in range(len(r) - window + 1))
    out = []
    for r in raw:
        keep = bytearray(b"\1" * len(r))
        for i in range(len(r) - window + 1):
            if counts[r[i : i + window]] > 1:
                keep[i : i + window] = bytes(window)
        spans = len([x for x in bytes(keep).split(b"\1") if x])
        out.append((len(r), keep.count(0), spans, hashlib.sha256(bytes(b for b, f in zip(r, keep) if f)).hexdigest()))
    return out


def test_suffix_arrays_of_random_strings():
    rng = random.Random(5)
    cases = ["".join(rng.choice("ab" if k % 3 else "abcd") for _ in range(rng.randint(0, 40))) for k in range(1500)]
    for s in [*cases, "a" * 300, "ab" * 200, "abc" * 70 + "ab", ""]:
        assert suffix_array(s) == sorted(range(len(s)), key=lambda i: s[i:]), s


@pytest.mark.parametrize("most_sorted", [4096, 1])
def test_repeated_passages_match_brute_force(spark, most_sorted):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(60) for _ in range(4)]
    texts = [text(rng.randint(0, 80)) + rng.choice(passages)[rng.randrange(60) :] + text(rng.randint(0, 80)) for _ in range(60)]
    texts += [None, "", "x" * 199, "x" * 200, "y" * 700, "ab" * 300, texts[0], passages[1], "z" * 201]
    rows = list(enumerate(texts)) + [(500, texts[3]), (500, texts[3]), (None, texts[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("clash")).withColumn("anchor", F.lit(1))
    got = remove_repeats(docs, most_sorted=most_sorted).collect()
    told = Counter((r["doc_id"], r["repeat_bytes"], sum(s["end"] - s["start"] for s in r["repeat_spans"]), len(r["repeat_spans"]), hashlib.sha256(r["repeat_kept"]).hexdigest()) for r in got)
    assert told == Counter((i, *w) for (i, _), w in zip(rows, removed(rows)))
    assert all(r["id"] == "clash" for r in got) and remove_repeats(docs.limit(0)).count() == 0


def test_top_k_matches_all_scores(spark):
    rng = np.random.default_rng(3)
    vectors = [[float(x) for x in rng.normal(size=6)] for _ in range(400)] + [[0.5, -0.25, 0.0, 0.1, 0.2, 0.3]] * 120
    rows = [(i, v, i) for i, v in enumerate(vectors)]
    rows += [(600, None, 0), (650, [1.0, None] + [0.0] * 4, 0), (700, [float("nan")] * 6, 0), (750, [float("inf")] * 6, 0), (None, [1.0] * 6, 0), (800, [1e6, -1e6] + [0.0] * 4, 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    floored = {i: np.floor(256 * np.array(v)) for i, v, _ in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    want = set()
    for q in (i for i in floored if i % 50 == 0):
        best = sorted((-int(floored[q] @ floored[i]), i) for i in floored if i != q)[:5]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(best)}
    assert {tuple(r) for r in top_k(table).select("query_id", "rank", "vec_id", "score").collect()} == want
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-3.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, top_k(few).collect())) == [(0, 1, 1, 256 * 512), (0, 2, 2, -256 * 768)]
    assert top_k(few.limit(0)).count() == 0 and top_k(few.where("vec_id > 0")).count() == 0


def test_byte_net_gradients_are_right():
    net, rng = ByteNet(["a", "b", "c"]), np.random.default_rng(2)
    net.weights = {k: w.astype(np.float64) for k, w in net.weights.items()}
    x, y = rng.integers(1, 256, (5, 40)).astype(np.uint8), np.array([0, 1, 2, 1, 0])
    _, g = net.gradients(x, y)
    for name, w in net.weights.items():
        at = np.unravel_index(np.abs(g[name]).argmax(), w.shape)
        held = w[at]
        w[at] = held + 1e-6
        up = net.gradients(x, y)[0]
        w[at] = held - 1e-6
        assert abs((up - net.gradients(x, y)[0]) / 2e-6 - g[name][at]) < 1e-4, name
        w[at] = held


def test_language_of_held_out_texts(spark):
    rng = random.Random(6)
    words = {"aa": "lorem ipsum dolor sit amet".split(), "bb": "zwei drei vier fünf sechs".split()}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(30 + i)), k, f"s{i % 3}", None) for i in range(240) for k in [("aa", "bb")[i % 2]]]
    odd = [(1001, None, "aa", None, None), (1002, "", "aa", None, None), (1003, "123 !?", "bb", None, None), (1004, "vier fünf " * 20_000, None, None, None), (None, "dolor sit amet " * 9, "aa", None, None)]
    docs = spark.createDataFrame(rows + odd + [rows[0]], DOCS).withColumn("score", F.lit("clash"))
    got = identify_language(docs).collect()
    assert len(got) == len(rows) + 6
    by_id = {r["doc_id"]: r for r in got}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)
    held = [i for i, *_ in rows if by_id[i]["held_out"]]
    assert len(held) > 20 and np.mean([by_id[i]["lang_pred"] == ("aa", "bb")[i % 2] for i in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got) and [by_id[i]["lang_pred"] for i in (1001, 1002, 1003, 1004, None)] == ["und"] * 3 + ["bb", "aa"]
    assert fit_language(docs.where("lang IS NULL")) is None and predict_language(docs.limit(2), None).first()["lang_pred"] == "und"
    assert identify_language(docs.limit(0)).count() == 0


def test_texts_of_no_learned_language_are_rejected(spark):
    rng = random.Random(6)
    words = {"aa": "lorem ipsum dolor sit amet".split(), "bb": "zwei drei vier fünf sechs".split()}
    rows = [(i, " ".join(rng.choice(words[k]) for _ in range(30)), k, None, None) for i in range(300) for k in [("aa", "bb")[i % 2]]]
    mixed = [(2000 + i, " ".join(rng.choice(words["aa" if j % 2 else "bb"]) for j in range(40)), None, None, None) for i in range(5)]
    odd = [(1000, "日本語の文章です。今日は天気がいい。" * 20, None, None, None), (1001, "qzxj vkpw xqjk " * 40, None, None, None), *mixed]
    docs = spark.createDataFrame(rows + odd, DOCS)
    least = least_score(docs, fit_language(docs))
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs, "").collect()}
    assert least > 0.75 and len(kept & set(range(300))) >= 290 and not kept & {r[0] for r in odd}, (least, kept & {r[0] for r in odd})
    assert least_score(docs.where("lang IS NULL"), None) == 0.0


def test_least_score_reads_every_held_out_document(spark, monkeypatch):
    told = lambda df, net: df.withColumns({"__lang_pred": F.lit("aa"), "__lang_score": F.col("text").cast("double")})
    monkeypatch.setattr(byte_cnn, "with_language", told)
    n = 30_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") * 7919 % n / n).cast("string").alias("text"), F.lit("aa").alias("lang"))
    scores = [i * 7919 % n / n for i in range(n) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(scores) > 5000 and least_score(docs, ByteNet(["aa"])) == pytest.approx(np.percentile(scores, 1) - 1e-9, abs=1e-12)


def test_exact_quantiles_without_ordering_all_values(spark, monkeypatch):
    monkeypatch.setattr(byte_cnn, "QUANTILE_PARTS", 4)
    rng = random.Random(3)
    for values in ([0.5], [0.25] * 40, [rng.random() for _ in range(300)], [rng.choice([0.1, 0.1 + 2**-52, 0.9]) for _ in range(60)]):
        df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
        for share in (0.0, 0.01, 0.5, 1.0):
            assert byte_cnn.exact_quantile(df, "v", share) == df.agg(F.percentile("v", share)).first()[0], (values, share)
    assert byte_cnn.exact_quantile(df.limit(0), "v", 0.5) is None


def test_training_sample_is_bounded_for_null_and_repeated_ids(spark, monkeypatch):
    rows = [(None, f"some text {i}", "aa", None, None) for i in range(900)] + [(3, f"other text {i}", "bb", None, None) for i in range(900)] + [(4, "same text", "bb", None, None)] * 300
    docs, seen = spark.createDataFrame(rows, DOCS), []
    monkeypatch.setattr(ByteNet, "train", lambda self, x, y, epochs=4: seen.append(Counter(y.tolist())))
    fit_language(docs, sample_docs=50, sample_windows=1)
    assert len(seen) == 1 and all(40 <= n <= 50 for n in seen[0].values()) and len(seen[0]) == 2


def test_periods_keep_every_source_within_a_block():
    rng = random.Random(2)
    for case in range(30):
        weights = {f"s{k}": rng.choice([1, 1, 2, 5, 40, 0.01, rng.random() + 0.001]) for k in range(rng.randint(1, 12))}
        shares = whole_shares(weights, 128)
        total, seen = sum(shares.values()), Counter()
        order = one_period(shares)
        assert [slot for _, _, slot in order] == list(range(total)) and total == 128
        for source, block, slot in order:
            assert block == seen[source]
            seen[source] += 1
            assert all(abs(seen[s] - (slot + 1) * n / total) < 1 for s, n in shares.items()), weights
    with pytest.raises(ValueError):
        whole_shares({"a": 0.0})


def test_schedules_follow_the_weights_and_keep_all(spark):
    rows = [(i, "t", None, "big" if i < 900 else f"s{i % 3}" if i < 1200 else None, 1) for i in range(1250)]
    docs = spark.createDataFrame(rows + [rows[0], (None, "t", None, "big", 1)], DOCS).withColumn("mix_slot", F.lit("clash"))
    weights = {"big": 0.5, "s0": 0.125, "s1": 0.125, "s2": 0.125, "": 0.125}
    got = schedule(docs, weights, block_docs=4, period=64).collect()
    assert len(got) == 1251 and len({(r["mix_slot"], r["mix_place"]) for r in got}) == 1251
    blocks = {(r["mix_slot"], r["source"]) for r in got}
    assert len(blocks) == len({slot for slot, _ in blocks})
    seen = Counter()
    for slot, source in sorted(blocks)[:90]:  # the null source is the first to run out, after 13 blocks
        seen[source] += 1
        assert all(abs(seen[s] - (slot + 1) * w) < 1 for s, w in weights.items())
    mixed = mix_sources(docs.drop("mix_slot"), weights, block_docs=4, period=64)
    assert mixed.columns == docs.columns[:-1] and Counter(mixed.collect()) == Counter(docs.drop("mix_slot").collect())
    place = {(r["doc_id"], r["source"]): (r["mix_slot"], r["mix_place"]) for r in got}
    turns = [place[(r["doc_id"], r["source"] or "")] for r in mixed.collect()]
    assert turns == sorted(turns)
    with pytest.raises(ValueError, match="without a target weight"):
        schedule(docs, {"big": 1.0})
    assert schedule(docs.limit(0)).count() == 0 and mix_sources(docs.limit(0)).count() == 0 and schedule(docs).count() == 1251


def test_equal_sources_stay_within_a_block_of_their_target_weight(spark):
    docs = spark.range(20 * 1200).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 20).alias("source"))
    rows = schedule(docs, block_docs=4, period=1000).select("mix_slot", "source").distinct().collect()
    order = [s for _, s in sorted((r["mix_slot"], r["source"]) for r in rows)]
    assert len(order) == 20 * 300 and [r["mix_slot"] for r in sorted(rows)] == list(range(len(order)))  # several periods of 1024
    seen = Counter()
    for slot, source in enumerate(order, 1):
        seen[source] += 1
        assert all(abs(seen[f"s{k}"] - Fraction(slot, 20)) < 1 for k in range(20))


def test_deals_of_any_weights_keep_the_bound_over_many_blocks():
    rng = random.Random(4)
    for case in range(15):
        weights = {f"s{k}": rng.choice([1, 2, 40, 1e-5, rng.random() + 0.001, rng.randint(1, 9999) ** 0.5]) for k in range(rng.randint(1, 9))}
        total, blocks = sum(map(Fraction, weights.values())), {s: rng.choice([0, 1, 300, 4000]) for s in weights}
        last, seen = -1, Counter()
        for source, block, slot in deal(weights, blocks):
            share = Fraction(weights[source]) / total
            assert slot > last and block == seen[source]
            assert abs(block - slot * share) < 1 and abs(block + 1 - (slot + 1) * share) < 1, weights
            last, seen[source] = slot, block + 1
        assert seen == Counter({s: n for s, n in blocks.items() if n})


def test_ranks_number_each_key_once(spark):
    table = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"))
    ranks = hashed_ranks(table, "k", ["id"], 5000, "r").groupBy("k").agg(F.count("*").alias("n"), F.min("r").alias("lo"), F.max("r").alias("hi"), F.count_distinct("r").alias("d"))
    assert all((r["lo"], r["hi"], r["d"]) == (0, r["n"] - 1, r["n"]) for r in ranks.collect())


def test_prompts_are_the_longest_common_prefix(spark):
    rng, rows, want = random.Random(9), [], []
    for conv in range(60):
        n = rng.randint(0, 5)
        rows += [(conv, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "", None, "x"])) for t in range(n)]
    rows += [(100, None, "user", "a"), (100, 1, "user", "b"), (100, 1, "assistant", "a"), (101, 0, "user", "a"), (None, 0, "user", "lost"), (103, 0, "assistant", "only rejected")]
    convs = {}
    key = lambda r: tuple((x is not None, x) for x in r[1:])
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        convs.setdefault(r[0], []).append(r[2:])
    for pair in sorted({c // 2 for c in convs}):
        a, b = convs.get(2 * pair, []), convs.get(2 * pair + 1, [])
        n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        for side, turns in (("chosen", a), ("rejected", b)):
            for k, (role, text) in enumerate(turns):
                if k >= n or side == "chosen":
                    want.append((pair, "prompt" if k < n else side, k, role, f"<|im_start|>{role or ''}\n{text or ''}<|im_end|>\n", k >= n and role == "assistant", n))
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("place", F.lit("clash"))
    assert Counter(map(tuple, format_pairs(turns, neighbour_pairs(turns)).collect())) == Counter(want)
    none = turns.limit(0)
    assert format_pairs(none, neighbour_pairs(none)).count() == 0


def test_long_conversations_are_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr("tempora.llm.preference.PART", 10)
    turns = spark.range(200).select((F.col("id") % 2).alias("conv_id"), F.floor(F.col("id") / 2).alias("turn"), F.lit("user").alias("role"), (F.col("id") / 2).cast("int").cast("string").alias("text"))
    got = format_pairs(turns, neighbour_pairs(turns)).collect()
    assert len(got) == 100 and {r["section"] for r in got} == {"prompt"} and sorted(r["place"] for r in got) == list(range(100))


def test_pipeline_stages_do_what_they_say(spark):
    rng = random.Random(21)
    texts = near_copies(rng, 6, 4, 80, 3)
    passage = " ".join(f"p{k}" for k in range(80))
    texts += [" ".join(f"q{rng.randrange(10**6)}" for _ in range(60)) + " " + passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(60)) for _ in range(5)]
    rows = [(i, t, "xx", f"s{i % 2}", len(t)) for i, t in enumerate(texts)] + [(900, "123 456", "xx", "s0", 7), (901, None, "xx", None, None), (902, "", None, "s1", 0)]
    docs, names = spark.createDataFrame(rows, DOCS), DOCS.replace(" long", "").replace(" string", "").split(", ")
    kept = [n for n, _ in corpus_pipeline.STAGES]
    assert kept == ["language", "near_dedup", "repeats", "mix", "encode"]
    stages = dict(corpus_pipeline.STAGES)
    spoken = stages["language"](spark, docs, "")
    assert spoken.columns == names and {r["doc_id"] for r in spoken.collect()} == set(range(len(texts)))
    single = stages["near_dedup"](spark, spoken, "")
    assert single.columns == names and {r["doc_id"] for r in single.collect()} == set(classes([(i, t) for i, t in enumerate(texts)]).values())
    cut = stages["repeats"](spark, single, "")
    assert cut.columns == names and not any("p40" in r["text"] for r in cut.collect()) and all(r["n_chars"] == len(r["text"]) for r in cut.collect())
    mixed = stages["mix"](spark, cut, "")
    assert mixed.columns == names and Counter(mixed.collect()) == Counter(cut.collect())
    assert {r["doc_id"] for r in stages["encode"](spark, mixed, "").collect()} == {r["doc_id"] for r in single.collect()}
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0, name


def test_the_pipeline_returns_the_order_of_the_mix(spark, tmp_path, monkeypatch):
    rng = random.Random(33)
    texts = [" ".join(f"q{rng.randrange(10**6)}" for _ in range(10 if i < 200 else 400)) for i in range(300)]
    rows = [(i, t, "xx", "a" if i < 200 else f"s{i % 3}", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [x for x in corpus_pipeline.STAGES if x[0] in ("mix", "encode")])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files of different sizes
    try:
        got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    turns = {r["doc_id"]: (r["mix_slot"], r["mix_place"]) for r in schedule(docs).collect()}
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["mix_place"])] == sorted(turns, key=turns.get)
    assert len({r["mix_place"] >> 43 for r in got}) > 1


def test_windows_have_one_anchor_each():
    rng = random.Random(8)
    small = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    found = suffix_groups.contexts(small, 9, 4)
    starts = Counter()
    for t, first, last, at in zip(*(found[k].tolist() for k in ("text", "first", "last", "at"))):
        for s in range(first, last + 1):
            starts[t, s] += 1
            assert s <= at <= s + 5
    assert starts == Counter((t, s) for t, r in enumerate(small) for s in range(len(r) - 8))


def test_rows_that_repeat_id_and_text_do_not_multiply(spark):
    rng = random.Random(5)
    whole = "".join(rng.choice("abcdefghij ") for _ in range(1000))
    rows = [(None, whole)] * 3000 + [(1, whole[:500] + "x" * 300), (2, whole[700:] + "short"), (3, "unlike " + whole[:150]), (4, None)]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    counts = {(r["doc_id"], len(r["repeat_kept"]), len(r["repeat_spans"])): r["n"] for r in got.groupBy("doc_id", "repeat_kept", "repeat_spans").agg(F.count("*").alias("n")).collect()}
    # 300 letters x hold 200-byte strings that repeat inside the text, so nothing of row 1 is left.
    assert counts == {(None, 0, 1): 3000, (1, 0, 1): 1, (2, 5, 1): 1, (3, 157, 0): 1, (4, 0, 0): 1}


def test_batches_sent_to_python_are_bounded_by_bytes(spark):
    docs = spark.range(0, 6000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 800).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    spark.conf.unset(BATCH_SETTING)
    assert encode_decode(docs, vocabulary_path()).count() == 6000
    got = docs.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r["n"] for r in got) == 6000 and max(r["bytes"] for r in got) < BATCH_BYTES + 10_000
    spark.conf.set(BATCH_SETTING, "123456")  # what the session sets stands
    encode_decode(docs, vocabulary_path())
    assert spark.conf.get(BATCH_SETTING) == "123456"
    spark.conf.unset(BATCH_SETTING)


def test_free_memory_goes_back_to_the_system():
    def held():
        return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) >> 10

    blocks = [bytearray(b"x") * 100_000 for _ in range(2000)]
    del blocks[:-1]  # the last one keeps the others' place below it
    before = held()
    give_back()
    assert held() < before - 100
