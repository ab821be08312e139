"""Token alignment, decontamination and spelling variants, compared with plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tempora.llm import training_suffixes
from tempora.llm.common import stored
from tempora.llm.queries import vocabulary_path
from tempora.llm.spelling_bits import near_words, spelling_groups, word_counts
from tempora.llm.token_alignment import align_tokenizers, align_texts, merged, spilled, vocabulary_size, with_pair_counts
from tempora.llm.training_suffixes import decontaminate, suffix_array, with_matches

DOCS = "doc_id long, text string"


# Token alignment


def plain_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    shown = {c: chr(b) for b, c in zip([*range(33, 127), *range(161, 173), *range(174, 256)], [*map(chr, range(33, 127)), *map(chr, range(161, 173)), *map(chr, range(174, 256))])}
    rest = [b for b in range(256) if chr(b) not in shown]
    decode = {c: ord(v) for c, v in shown.items()} | {chr(256 + i): b for i, b in enumerate(rest)}
    rows, counts = [], Counter()
    for t in texts:
        if not t:
            rows.append(None)
            continue
        a, b = a_side.encode(" " + t, add_special_tokens=False).ids, b_side.encode(t)
        a_bytes = [bytes(decode[c] for c in a_side.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(a_bytes) != (" " + t).encode() or b"".join(b_bytes) != (" " + t).encode():
            rows.append(None)
            continue
        ends = [dict(zip(np.cumsum([len(x) for x in side]).tolist(), ids, strict=True)) for side, ids in ((a_bytes, a), (b_bytes, b))]
        cuts = sorted(ends[0].keys() & ends[1].keys())
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for e, i in side.items() if low < e <= cut) for side in ends))
            low = cut
        links = [(ends[0][c], ends[1][c]) for c in cuts]
        counts.update(links)
        rows.append((len(a), len(b), len(groups), links, ";".join(groups)))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(0, 0, 0, 0, "", 0, 0) if r is None else (r[0], r[1], r[2], len(r[3]), r[4], sum(counts[x] == best[x[1]] for x in r[3]), sum(counts[x] for x in r[3])) for r in rows]


TEXTS = [
    None, "", " ", "one", "the cat sat", "the cat sat", "The CAT  sat\n\non the mat.", "<|endoftext|> and <s> </s> <unk> <0x41>", "under▁score",
    "naïve café ﬁne Ωmega 東京 😀👍🏽", "x\x00y\t\tz", " lead", "trail ", "a" * 3000, "12345 67,890.12", "it's we'll don't", "é", "\n\n\n", "the the the the cat",
]


def test_alignment_matches_both_libraries(spark):
    rng = random.Random(3)
    texts = TEXTS + [" " * 2500 + "x", "\n" * 2100] + [" ".join(rng.choice(["the", "cat", "sat", "onñ", "mat.", "Ωx", "tion"]) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    paths = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
    rows = [(None if i == 4 else i // 2, t, "x", "y") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS + ", runs string, doc_key string").repartition(3)
    got = align_tokenizers(docs, *paths)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    assert set(got.columns) == set(columns)
    want = Counter((r[0], *x) for r, x in zip(rows, plain_alignment(texts), strict=True))
    assert Counter(tuple(r) for r in got.select(columns).collect()) == want
    # The same when every digit's runs are dealt over many parts.
    parted = with_pair_counts(stored(align_texts(docs, *paths), "test"), vocabulary_size(paths[0]), part_bytes=40)
    assert Counter(tuple(r) for r in parted.select(columns).collect()) == want
    assert align_tokenizers(docs.limit(0), *paths).count() == 0


def test_runs_merge_to_the_counts_of_all_links():
    rng = np.random.default_rng(0)
    total, frames = Counter(), defaultdict(list)
    for _ in range(7):
        text, pair = np.sort(rng.integers(0, 9, 3000)), rng.zipf(1.3, 3000) % 70_000
        total.update(pair.tolist())
        for r in spilled(text, pair, 100):
            frames[r["digit"]].append(r["head"])
    got = {}
    for digit, heads in frames.items():
        pairs = [p for block, _ in merged(heads) for p in block.tolist()]
        assert pairs == sorted(set(pairs)) and all(p // 100 % 32 == digit for p in pairs)
        got |= {p: n for block, times in merged(heads) for p, n in zip(block.tolist(), times.tolist(), strict=True)}
    assert got == total
    assert list(merged([])) == []


# Decontamination


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_leaks(text, items, window=10):
    words, hit, named = plain_words(text), set(), set()
    for item_id, item in items:
        w = plain_words(item)
        n = min(window, len(w))
        grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        places = [i for i in range(len(words) - n + 1) if n and tuple(words[i : i + n]) in grams]
        hit |= {i + k for i in places for k in range(n)}
        if places and item_id is not None:
            named.add(str(item_id))
    return len(words), hit, sorted(named)


@pytest.mark.parametrize("block_words", [1 << 20, 25])
def test_matches_equal_all_windows(spark, monkeypatch, block_words):
    monkeypatch.setattr(training_suffixes, "PIECE_WORDS", 16)
    rng = random.Random(5)
    word = lambda: rng.choice(["Alpha", "beta", "gamma", "ñu", "δ", "e5", "f"])
    passage = [f"w{i}" for i in range(60)]
    items = [(1, " ".join(passage[:30])), (2, " ".join(passage[20:])), (3, "Short Item here"), (4, "Short item, HERE!"), (5, None), (6, "..."), (None, "no id at all"), (7, "f f")]
    items += [(10 + i, " ".join(word() for _ in range(rng.randint(1, 25)))) for i in range(12)] + [(1, " ".join(passage[:30])), (9, " ".join(passage[:30]))]
    texts = [None, "", "...", " ".join(passage), "x " + "-".join(passage[5:15]).upper() + " y", " ".join(passage[5:14]), "a short ITEM\nhere b", "no id at all", "f f f f", "F"]
    texts += [" ".join(word() for _ in range(rng.randint(1, 300))) for _ in range(30)] + [" ".join(passage[22:29]) + " " + " ".join(passage[10:45])] * 3
    docs = spark.createDataFrame([(None if i == 3 else i, t, i) for i, t in enumerate(texts)], DOCS + ", place long").repartition(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["place"]: r for r in with_matches(docs, bench, block_words=block_words).collect()}
    assert len(got) == len(texts)
    of_item = defaultdict(list)
    for i, t in items:
        of_item[None if i is None else str(i)].append(plain_words(t))
    for i, t in enumerate(texts):
        n, hit, named = plain_leaks(t, items)
        r = got[i]
        assert r["leak_words"] == n and r["leak_items"] == named
        assert {k for s in r["leak_spans"] for k in range(s["start"], s["end"])} == hit
        words = plain_words(t)
        for m in r["leak_matches"]:  # verbatim, at the stated places
            assert any(w[m["item_start"] : m["item_start"] + m["words"]] == words[m["start"] : m["start"] + m["words"]] for w in of_item[m["item_id"]])
    kept = {r["place"] for r in decontaminate(docs, bench, block_words=block_words).collect()}
    assert kept == {i for i, t in enumerate(texts) if not plain_leaks(t, items)[1]}


def test_longest_match_is_one_row(spark):
    passage = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, "x " + " ".join(passage[3:33]) + " y")], DOCS)
    bench = spark.createDataFrame([(8, " ".join(passage))], "item_id long, text string")
    (row,) = with_matches(docs, bench).collect()
    assert [tuple(m) for m in row["leak_matches"]] == [("8", 3, 1, 30)]


def test_empty_tables_and_taken_names(spark):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c")], DOCS)
    assert with_matches(docs.limit(0), bench).count() == 0
    assert [r["leak_spans"] for r in with_matches(docs, bench.limit(0)).collect()] == [[]]
    with pytest.raises(ValueError, match="leak_items"):
        with_matches(docs.selectExpr("*", "1 AS leak_items"), bench)


def test_long_text_and_many_copies(spark):
    item = " ".join(f"w{i}" for i in range(12))
    rows = [(i, f"filler {item} more") for i in range(500)] + [(1000, "pad " * 400_000 + item)]
    bench = spark.createDataFrame([(i, item) for i in range(50)], "item_id long, text string")
    got = with_matches(spark.createDataFrame(rows, DOCS), bench).collect()
    assert all(len(r["leak_matches"]) == 1 and len(r["leak_items"]) == 50 for r in got)
    assert {r["leak_spans"][0]["start"] for r in got} == {1, 400_000}


def test_suffix_array_orders_by_the_words_that_follow():
    rng = np.random.default_rng(2)
    for high in (2, 3, 40, 1 << 40):
        ids = np.concatenate([np.where(rng.random(400) < 0.1, 0, rng.integers(1, high, 400)), np.zeros(10, np.int64)])
        array = suffix_array(ids, 10)
        assert sorted(array) == np.flatnonzero(ids).tolist()
        until = lambda p: [x for x in ids[p : p + 10].tolist()]
        cut = lambda x: x[: x.index(0)] if 0 in x else x
        keys = [cut(until(p)) for p in array]
        assert all(a <= b for a, b in zip(keys, keys[1:], strict=False))


# Spelling variants


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


@pytest.mark.parametrize("full_bucket", [4096, 3])
def test_near_words_equal_all_pairs(spark, full_bucket):
    rng = random.Random(8)
    words = {"".join(rng.choice("abñ") for _ in range(rng.randint(7, 10))) for _ in range(700)} | {"abcdefgh" * 20, "abcdefgh" * 20 + "x", "q" + "abcdefgh" * 20}
    counts = {w: rng.choice([2, 3, 50, 500]) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = {r["word"]: (r["n_near"], r["near_n"], r["near"]) for r in near_words(table, full_bucket).collect()}
    want = {}
    for w in words:
        near = [x for x in words if one_apart(w, x)]
        if near:
            best = min(near, key=lambda x: (-counts[x], x))
            want[w] = len(near), counts[best], best
    assert got == want and len(want) > 100


def plain_counts(rows, noise=31):
    held = Counter()
    for doc_id, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            held[w[: h % len(w)] + w[h % len(w) + 1 :] if h % noise == 0 else w] += 1
    return held


def test_spelling_groups_equal_plain_python(spark):
    rng = random.Random(9)
    base = ["Ordinary", "ordinàry", "language", "langüage", "Übermut", "statement", "×÷letters"]
    rows = [(i % 90, " ".join(rng.choice(base) for _ in range(rng.randint(0, 80))) + ", é1x") for i in range(300)]
    rows += [(None, "ordinary ordinary language"), (5, None), (6, ""), (7, "a" * 50_000 + " " + "a" * 50_000 + " " + "a" * 49_999 + "b"), (7, "a" * 50_000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS + ", word string, n long").repartition(3)
    counts = plain_counts(rows)
    assert {r["word"]: r["n"] for r in word_counts(docs).collect()} == counts
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    want = {}
    for w, n in words.items():
        near = [x for x in words if one_apart(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 10 * n else None
        want[w] = [form, w, n, len(near), words.get(form)]
    for w, v in want.items():
        while want[v[1]][0]:
            v[1] = want[v[1]][0]
    got = {r["word"]: [r["form"], r["root"], r["n"], r["n_near"], r["form_n"]] for r in spelling_groups(docs, full_bucket=4).collect()}
    assert got == want and sum(v[0] is not None for v in want.values()) > 10
    assert spelling_groups(docs.limit(0)).count() == 0


def test_roots_follow_chains(spark):
    rows = [(1, " ".join(["abcdefg"] * 2 + ["abcdefgh"] * 20 + ["abcdefghi"] * 200 + ["abcdefghij"] * 2000))]
    got = {r["word"]: (r["form"], r["root"]) for r in spelling_groups(spark.createDataFrame(rows, DOCS), noise=1 << 40).collect()}
    assert got["abcdefg"] == ("abcdefgh", "abcdefghij") and got["abcdefghij"] == (None, "abcdefghij")
