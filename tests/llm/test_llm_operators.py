"""The training-data operators against brute force, and their defined results at the edges."""

import datetime as dt
import gzip
import random
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import (
    common,
    decontaminate,
    main_text,
    ngram_join,
    passages,
    pieces,
    quality,
    token_counts,
    top_k,
    url_filter,
    warc,
)

DOCS = "doc_id bigint, text string, lang string"


def words_of(text):
    low = (text or "").translate(str.maketrans(common.UPPER, common.LOWER))
    return passages.WORD.findall(low)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        i = rng.randrange(len(w))
        w[i : i + 1] = rng.choice([[], [prose(rng, 1)], [w[i], prose(rng, 1)]])
    return " ".join(w)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    base = [prose(rng, rng.randint(30, 200)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, edited(rng, base[i % 6], i % 5)) for i in range(40)]
    rows += [(200 + i, base[3]) for i in range(20)]
    rows += [(300, None), (301, ""), (302, " \t\n "), (303, "One"), (304, "one"), (305, "one two"), (306, "ONE  two ")]
    return rows


# Components


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 301), (301, 302), (302, 300), (7, 7)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in common.components(df).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(50))
    assert {got[i] for i in (300, 301, 302)} == {300}
    assert common.components(df.limit(0)).count() == 0


def test_sieve_keeps_all_and_nulls_pass(spark):
    docs = spark.createDataFrame([(i, "t") for i in range(50)] + [(None, "n")], "doc_id bigint, text string")
    ids = spark.createDataFrame([(i,) for i in range(0, 50, 5)], "doc_id bigint")
    left = {r["doc_id"] for r in common.drop_ids(docs, ids).collect()}
    assert left == {i for i in range(50) if i % 5} | {None}


# 4 URL filters


def judged(url, rules, default="allow"):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = rest[:cut].translate(str.maketrans(common.UPPER, common.LOWER)), rest[cut:]
        path = tail.split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else default


def test_url_rules_match_brute_force(spark):
    rng = random.Random(3)
    rules = [
        ("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.net", "/x/y", "block"), ("org", "", "block"),
        ("b.org", "/q", "allow"), ("b.org", "/q", "block"), ("example.com", "/de/", "block"), ("x.y.example.com", "/", "allow"),
    ]
    hosts = ["net", "a.NET", "example.net", "s.example.net", "xexample.net", "b.org", "c.b.org", "x.y.example.com", "w.x.y.example.com", "", "a..net"]
    paths = ["", "/", "/en/", "/en/1", "/x/y", "/x/yz?u=/en/", "/q", "/de/#a", "?/en/", "#/", "/x\n/y"]
    urls = [f"{rng.choice(['http', 'HTTPS', ''])}://{h}{p}" for h in hosts for p in paths] + [None, "", "net/", "a://b://net/"]
    urls += ["http://" + ".".join(["l"] * 300) + ".net" + "/p" * 400, urls[0]]
    df = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)], "page_id bigint, url string, Verdict string")
    frame = spark.createDataFrame([*rules, (None, "/", "block")], "host string, path string, action string")
    got = {r["page_id"]: tuple(r)[2:] for r in url_filter.judge_urls(df, frame).collect()}
    assert got == {i: judged(u, rules) for i, u in enumerate(urls)}
    none = url_filter.judge_urls(df, frame.limit(0), default="block").collect()
    assert len(none) == len(urls) and {r["verdict"] for r in none} == {"block"}
    assert url_filter.judge_urls(df.limit(0), frame).count() == 0


# 5 n-gram join


def sets_of(text, size):
    w = words_of(text)
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute_components(rows, size, percent):
    sets = {i: sets_of(t, size) for i, t in rows}
    least = {i: i for i in sets}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    least[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (2, 50)])
def test_ngram_components_match_brute_force(spark, corpus, size, percent):
    df = spark.createDataFrame(corpus, "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link_components(df, size, percent).collect()}
    assert got == brute_components(corpus, size, percent)


def test_ngram_join_edges(spark, corpus):
    df = spark.createDataFrame(corpus + [(None, corpus[0][1]), (9, corpus[3][1]), (100, corpus[100 % 12][1])], "doc_id bigint, text string")
    rows = ngram_join.link_components(df).collect()
    assert len(rows) == len(corpus) + 3
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    # doc 9 has two texts: its own and that of doc 3.
    assert {r["component_id"] for r in rows if r["doc_id"] in (3, 9)} == {3}
    assert ngram_join.link_components(df.limit(0)).count() == 0
    extra = df.withColumns({"n_shingles": F.lit("x"), "component_id": F.lit("y"), "token": F.lit(1)})
    kept = ngram_join.one_of_each(extra, 3, 90)
    assert kept.columns == extra.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and None in ids
    # doc 100 holds the text of doc 4 too, and is linked with doc 4 and with its own group.
    want = {c for _, c in brute_components(corpus, 3, 90).values()} - {4, 9}
    assert set(ids) - {None} == want


# 1 passages


def test_chain_beats_no_other_chain():
    """The Fenwick tree finds the best predecessor that a scan of all anchors finds."""
    rng = random.Random(8)
    s = passages.Settings(max_gap=10**6)
    for _ in range(60):
        found = sorted({(x, x + 5, y, y + 5) for x, y in ((rng.randrange(200), rng.randrange(200)) for _ in range(25))})
        score = []
        for x0, x1, y0, _ in found:
            gains = [score[j] - s.gap_cost * (x0 - a[1] + y0 - a[3]) for j, a in enumerate(found[: len(score)]) if a[1] <= x0 and a[3] <= y0]
            score.append(x1 - x0 + max([0.0, *gains]))
        best = passages.chains(found, s)[0]
        own = sum(a[1] - a[0] for a in best) - sum(s.gap_cost * (b[0] - a[1] + b[2] - a[3]) for a, b in zip(best, best[1:]))
        assert own == pytest.approx(max(score))


def test_common_is_least_edit_alignment():
    a, b = np.array([1, 2, 3, 4, 5]), np.array([1, 9, 3, 5])
    assert passages.common(a, b) == 3
    assert passages.common(a, a[:0]) == 0 and passages.common(a, a) == 5


def planted(rng):
    shared = prose(rng, 60)
    fuzzy = edited(rng, shared, 2)
    rows = [(i, f"{prose(rng, 80)} {shared if i % 2 else fuzzy} {prose(rng, 40)}") for i in range(10)]
    rows += [(50 + i, prose(rng, 150)) for i in range(5)]
    rows += [(90, "same " * 300), (91, "same " * 300), (92, None), (93, ""), (None, shared), (94, shared[: len(shared) // 3])]
    return shared, rows


def test_passages_are_found_and_clean_texts_left_alone(spark):
    shared, rows = planted(random.Random(1))
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, a int")
    got = passages.passages(df).collect()
    touched = {r["doc_a"] for r in got} | {r["doc_b"] for r in got}
    assert touched == set(range(10))
    text = {i: words_of(t) for i, t in rows}
    for r in got:
        assert r["doc_a"] < r["doc_b"] and r["n_words"] >= 50 and r["identity"] >= 0.8
        a, b = text[r["doc_a"]][r["a_start"] : r["a_end"]], text[r["doc_b"]][r["b_start"] : r["b_end"]]
        if r["doc_a"] % 2 and r["doc_b"] % 2:
            assert a == b and " ".join(a) in " ".join(text[r["doc_a"]])
    assert passages.passages(df.limit(0)).count() == 0


def test_passages_leave_their_later_holders(spark):
    shared, rows = planted(random.Random(1))
    df = spark.createDataFrame([(*r, len(r[1] or ""), "x") for r in rows], "doc_id bigint, text string, n_chars bigint, _spans string")
    df = df.drop("_spans")
    left = passages.remove_passages(df, passages.passage_pairs(df))
    assert left.columns == df.columns
    by = {r["doc_id"]: r for r in left.collect()}
    assert set(by) == {i for i, _ in rows}
    held = [i for i in range(10) if len(words_of(by[i]["text"])) > 150]
    assert held and all(by[i]["n_chars"] == len(by[i]["text"]) for i in range(10))
    assert len(held) <= 2 and by[50]["text"] == dict(rows)[50] and by[92]["text"] is None
    again = passages.passages(left).where("n_words > 55").count()
    assert again == 0


def test_a_text_of_passages_only_goes(spark):
    shared = prose(random.Random(2), 70)
    df = spark.createDataFrame([(1, shared), (2, shared), (3, shared + " tail")], "doc_id bigint, text string")
    left = {r["doc_id"]: r["text"] for r in passages.remove_passages(df, passages.passage_pairs(df)).collect()}
    assert left == {1: shared, 3: "tail"}


def test_exact_passages_apart_are_both_found():
    """Two passages of 60 words 40 words apart, and a copy of which each second paragraph is rewritten."""
    s, rng = passages.Settings(), np.random.default_rng(3)
    new = lambda n: rng.integers(1, 2**31 - 1, n).astype(np.int32)
    for kept, other, times in ((60, 40, 2), (50, 40, 4)):
        runs = [new(kept) for _ in range(times)]
        a, b = (np.concatenate([np.concatenate((new(other), r)) for r in runs] + [new(other)]) for _ in range(2))
        at = [other + i * (kept + other) for i in range(times)]
        chain = [(i + 3, i + kept - 3, i + 3, i + kept - 3) for i in at]
        assert sorted(passages.Spans(chain, a, b, s).all()) == [(i, i + kept, i, i + kept, 1.0) for i in at]


def test_a_long_run_before_does_not_break_a_chain():
    """The best predecessor within reach, where a better one is too far away."""
    s = passages.Settings()
    for far in (70, 300, 1000):
        at = 800 + far
        runs = [(at + i * 22, at + i * 22 + 21, at + i * 22, at + i * 22 + 21) for i in range(3)]
        assert runs in passages.chains([(0, 800, 0, 800), *runs], s)


def test_a_sparse_chain_hides_no_passage(spark):
    """Document 3 shares scattered words with 1 (too few for a passage) and, among them, a passage with 2."""
    rng = random.Random(6)
    rows = []
    for i in range(0, 100, 10):
        runs, passage = [prose(rng, 30) for _ in range(8)], prose(rng, 52)
        part = lambda own: " ".join(f"{r} {prose(rng, 20)}" for r in own[:-1]) + f" {own[-1]}"
        mixed = lambda mid: f"{part(runs[:4])} {mid} {part(runs[4:])}"  # noqa: E731, B023
        rows += [(i + 1, mixed(prose(rng, 52))), (i + 2, f"{prose(rng, 50)} {passage} {prose(rng, 50)}"), (i + 3, mixed(passage))]
    got = passages.passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(i + 2, i + 3) for i in range(0, 100, 10)} <= {(r["doc_a"], r["doc_b"]) for r in got}


@pytest.mark.parametrize("identity", [0.8, 0.85, 0.9, 0.95, 1.0])
def test_edited_passages_share_seeds_and_align(identity):
    """Passages of 50 to 80 words with words replaced at random."""
    s, rng = passages.Settings(), np.random.default_rng(5)
    new = lambda n: rng.integers(-(2**31), 2**31 - 1, n).astype(np.int32)
    for n in (50, 60, 80) * 10:
        p = new(n)
        q = p.copy()
        q[rng.choice(n, round(n * (1 - identity)), replace=False)] = new(round(n * (1 - identity)))
        a, b = np.concatenate((new(70), p, new(60))), np.concatenate((new(40), q, new(90)))
        assert len(np.intersect1d(*(passages.seeds_of(w.astype(np.int64), s)[0] for w in (a, b))))
        assert max((x1 - x0 for x0, x1, *_ in passages.shared(a, b, s)), default=0) >= 50


def test_regularly_edited_passages_are_found(spark):
    """Each eighth word of 60 replaced: seven equal words in a row, and few seeds."""
    rng = random.Random(12)
    rows = []
    for i in range(10):
        p = prose(rng, 60).split()
        q = [prose(rng, 1) if k % 8 == 3 else w for k, w in enumerate(p)]
        rows += [(2 * i, f"{prose(rng, 40)} {' '.join(p)} {prose(rng, 50)}"), (2 * i + 1, f"{prose(rng, 60)} {' '.join(q)} {prose(rng, 30)}")]
    got = passages.passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r["doc_a"], r["doc_b"]) for r in got} == {(2 * i, 2 * i + 1) for i in range(10)}


def test_lines_shared_outside_a_passage_do_not_hide_it(spark):
    """The lines of the passage of 50 and 60 stand alone, and two and two, in earlier and in later documents."""
    rng = random.Random(21)
    for _ in range(3):
        one, two, three = (prose(rng, 20) for _ in range(3))
        pieces = [one, two, three, f"{one} {two}", f"{two} {three}"]
        rows = [(k + i, f"{prose(rng, 30)} {p} {prose(rng, 30)}") for k in (1, 90) for i, p in enumerate(pieces)]
        rows += [(k, f"{prose(rng, 40)} {one} {two} {three} {prose(rng, 40)}") for k in (50, 60)]
        got = passages.passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
        # Brute force: only these two share 50 words.
        assert [tuple(r[:6]) for r in got] == [(50, 60, 40, 100, 40, 100)]


# 10 decontamination


def test_items_are_found_in_documents(spark):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.randint(30, 60))) for i in range(15)] + [(15, "alpha beta gamma"), (16, ""), (17, None), (3, "x y z q w e r t")]
    docs = [(i, f"{prose(rng, 50)} {items[i][1].upper() if i % 2 else items[i][1]} {prose(rng, 30)}") for i in range(10)]
    docs += [(20, items[10][1]), (21, "x alpha BETA gamma y"), (22, prose(rng, 90)), (23, None), (24, ""), (None, items[1][1])]
    near = items[11][1].split()
    near[1] = "changed"
    docs += [(25, prose(rng, 20) + " " + " ".join(near)), (26, " ".join(items[12][1].split()[:12])), (20, items[10][1])]
    d = spark.createDataFrame([(*r, "w") for r in docs], "doc_id bigint, text string, w string").repartition(3)
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.matches(d, b).collect()}
    want = {(i, i) for i in range(10)} | {(20, 10), (21, 15), (25, 11)}
    assert set(got) == want
    text = {i: words_of(t) for i, t in docs}
    for (doc, item), r in got.items():
        one, two = text[doc][r["start"] : r["start"] + r["n_words"]], words_of(items[item][1])
        k = min(5, len(two))
        assert r["similarity"] == pytest.approx(weighted(one, two, k), abs=1e-6)
    left = decontaminate.clean(d, b)
    assert left.columns == d.columns and {r["doc_id"] for r in left.collect()} == {22, 23, 24, 26, None}
    assert decontaminate.matches(d.limit(0), b).count() == 0 and decontaminate.matches(d, b.limit(0)).count() == 0


def weighted(a, b, k):
    from collections import Counter

    x, y = (Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) for w in (a, b))
    return sum((x & y).values()) / sum((x | y).values())


def test_every_fingerprint_in_the_radius_shares_a_block(spark):
    rng = random.Random(6)
    flips = set(decontaminate._flips())
    for _ in range(300):
        a, d = rng.getrandbits(64), rng.randint(0, decontaminate.RADIUS)
        b = a
        for bit in rng.sample(range(64), d):
            b ^= 1 << bit
        assert any(((a >> 16 * k) ^ (b >> 16 * k)) & 0xFFFF in flips for k in range(4))


# 2 and 3 pieces and tokens


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load()


def viterbi(text, table, alone):
    best = [(0.0, 0)] + [(-1e300, 0)] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - 40), end):
            own = table.get(text[start:end])
            own = alone if own is None and end - start == 1 else own
            if own is not None and best[start][0] + own > best[end][0]:
                best[end] = (best[start][0] + own, start)
    return best[-1][0]


def test_encoding_has_the_best_score_and_decodes(vocabulary):
    encoder = pieces.Encoder(vocabulary.pieces)
    table = {p: s for p, s, k in vocabulary.pieces if k == "piece"}
    rng = random.Random(1)
    texts = [prose(rng, 12), "The  quick brown\n\tfox", "naïve Ωmega 漢字 🙂 x", "a" * 60, "   ", "\n"]
    for text in texts:
        ids = np.frombuffer(encoder.encode(text), np.int32).tolist()
        marked = "▁" + text.replace(" ", "▁")
        kinds = [vocabulary.pieces[i] for i in ids]
        n_bytes = sum(k == "byte" for *_, k in kinds)
        alone = sum(c not in table for c in marked)
        assert (n_bytes > 0) == (alone > 0)
        score = sum(s for _, s, k in kinds if k == "piece") + alone * encoder.alone
        assert score == pytest.approx(viterbi(marked, table, encoder.alone))


def test_pieces_round_trip_and_edges(spark, vocabulary):
    texts = ["plain words here", "", None, " lead", "▁mark ▁", "a\r\nb\x00c", "🙂" * 50, "x" * 30000, "plain words here"]
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id bigint, text string, IDS string")
    coded = pieces.encode(df, vocabulary)
    assert coded.columns == ["doc_id", "text", "ids"]
    got = {r["doc_id"]: r for r in pieces.decode(coded, vocabulary).collect()}
    assert {i: r["decoded"] for i, r in got.items()} == dict(enumerate(texts))
    assert got[1]["ids"] == [] and got[2]["ids"] is None and got[0]["ids"] == got[8]["ids"]
    odd = spark.createDataFrame([([5, None, -1, 99999999, 300],)], "ids array<int>")
    assert pieces.decode(odd, vocabulary).first()["decoded"] is not None
    assert pieces.encode(df.limit(0), vocabulary).count() == 0


def greedy(word, vocabulary):
    n = 0
    while word:
        for size in range(len(word), 0, -1):
            if word[:size] in vocabulary:
                word, n = word[size:], n + 1
                break
        else:
            return 1
    return n


def test_counts_are_greedy_longest_match():
    rng = random.Random(2)
    for _ in range(40):
        vocabulary = {bytes(rng.choice(b" abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 30))}
        automaton = token_counts.Automaton(vocabulary)
        for _ in range(60):
            word = b" " + bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 12)))
            assert automaton.count(word) == greedy(word, vocabulary), (word, vocabulary)


def test_token_counts_of_rows(spark):
    ranks = token_counts.read_ranks()
    own = set(ranks)
    texts = ["Some words, twice. Some words, twice.", None, "", "\t \n", "naïve 🙂", "y" * 20000]
    df = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id bigint, text string, N_WORDS int")
    got = {r["doc_id"]: (r["n_tokens"], r["n_words"]) for r in token_counts.token_counts(df, ranks).collect()}
    assert got == {i: (sum(greedy(b" " + w, own) for w in (t or "").encode().split()), len((t or "").encode().split())) for i, t in enumerate(texts)}


# 8 quality


def test_votes_are_exact_and_learn(spark):
    rng = random.Random(3)
    good = [(i, prose(rng, 60), 1) for i in range(80)]
    bad = [(100 + i, ("BUY NOW!! " * 20) + prose(rng, 3).upper(), 0) for i in range(80)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in good + bad] + [(900, None), (901, ""), (902, "x"), (0, good[0][1])], "doc_id bigint, text string")
    docs = docs.withColumns({"score": F.lit("s"), "predicted": F.lit("p")})
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in good + bad] + [(5, None, 0), (None, 1, 0), (3, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = quality.judge(docs, labels).collect()
    assert len(got) == 164
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["predicted"] == q for i, _, q in good + bad)
    assert by[900]["score"] == by[901]["score"] == by[902]["score"] == 0.0
    import zlib

    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    none = quality.judge(docs, labels.limit(0)).collect()
    assert len(none) == 164 and {r["score"] for r in none} == {0.0}
    assert quality.judge(docs.limit(0), labels).count() == 0


def test_score_is_the_weighted_vote_of_the_nearest():
    rng = np.random.default_rng(0)
    s = quality.Settings(columns=64, rank=8, neighbours=5)
    block = rng.random((40, 64)).astype(np.float32)
    labels = rng.integers(0, 2, 40).astype(float)
    model = quality.fit(block, labels, s)
    x = rng.random((6, 64)).astype(np.float32)
    got = model.score(x)
    for row, one in zip(x, got):
        v = model.project(row[None])[0]
        cosine = np.array([float(v @ u) for u in model.vectors])
        near = np.argsort(-cosine)[:5]
        w = np.maximum(cosine[near], 0) ** s.sharpness
        assert one == pytest.approx((w * labels[near]).sum() / w.sum(), abs=1e-5)


# 7 top-k


def test_digits_and_sums():
    rng = np.random.default_rng(1)
    for q in [0, 1, -1, 7, -13, 255, -256, 1023]:
        d = top_k.digits(q)
        assert sum(s << k for k, s in d) == q and all(b[0] - a[0] > 1 for a, b in zip(d, d[1:]))


@pytest.mark.parametrize("rows", [16, 64, 1000])
def test_top_k_matches_brute_force(spark, rows):
    rng = np.random.default_rng(rows)
    vectors = [(int(i), [float(x) for x in rng.normal(0, 0.3, 6)]) for i in range(-100, 150)]
    vectors += [(500 + i, [0.5] * 6) for i in range(30)] + [(600, [0.0] * 6), (650, [1e3, -1e3, 0.0, 0.0, 0.0, 0.0]), (50, vectors[0][1])]
    vectors += [(700, None), (750, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (800, [float("nan")] + [0.0] * 5), (850, [float("inf")] + [0.0] * 5), (900, []), (None, [0.0] * 6)]
    vectors += [(950, [0.1, 0.2]), (951, [0.3, -0.2])]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>").withColumn("label", F.lit(1))
    v = top_k.quantised(df)
    got = sorted(tuple(r) for r in top_k.search(top_k.build_index(v, rows), v.where("vec_id % 50 = 0"), 5).collect())
    ints = {}
    for i, x in vectors:
        if i is not None and x and all(e is not None and np.isfinite(e) for e in x):
            q = [int(np.floor(256 * float(np.float32(e)))) for e in x]
            ints[i] = min(ints.get(i, q), q)
    want = []
    for q in ints:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(ints[q], x)), i) for i, x in ints.items() if i != q and len(x) == len(ints[q]))
            want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:5], 1)]
    assert got == sorted(want)
    empty = top_k.quantised(df.limit(0))
    assert top_k.search(top_k.build_index(empty), empty, 5).count() == 0


# 9 WARC


def test_archives_hold_every_page_once(spark, tmp_path):
    body = "<p>" + "é" * 120 + "</p>"
    rows = [(3, "http://a/", body), (1, "http://b/\r\nX: y", body), (2, None, body), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", "")]
    rows += [(1, "http://b/", body), (None, "u", body), (8, "u", "x" * 300000), (9, "u", "a\r\n\r\nWARC/1.1\r\n" * 20)]
    df = spark.createDataFrame([(*r, "e") for r in rows], "page_id bigint, url string, html string, member string").repartition(3)
    index = warc.write_archives(df, str(tmp_path / "archives"))
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.read_records(index).collect()), key=repr)
    want = []
    for page, _, html in rows:
        raw = (html or "").encode()
        own = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        revisit = len(raw) >= 100 and page != min(own)
        want.append((page, "revisit" if revisit else "response", min(own) if revisit else None, len(raw)))
    assert got == sorted(want, key=repr)
    by = {r["page_id"]: r["payload"] for r in warc.read_records(index.where("page_id = 9 or page_id = 6")).collect()}
    assert by == {9: rows[-1][2].encode(), 6: b""}
    # Every archive is a plain series of members that its index covers without a gap.
    for file, offset, length in index.select("file", "offset", "length").collect():
        with open(file, "rb") as f:
            f.seek(offset)
            assert gzip.decompress(f.read(length)).startswith(b"WARC/1.1\r\n")
    assert warc.read_records(warc.write_archives(df.limit(0), str(tmp_path / "none"))).count() == 0


def test_ranges_are_coalesced_in_order():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 30 + warc.GAP_BYTES, 5), ("b", 0, 1), ("b", 1, warc.READ_BYTES), ("b", 1 + warc.READ_BYTES, 3)]
    got = list(warc.ranges(rows))
    assert [g[3] for g in got] == [[0, 1], [2], [3], [4], [5]] and got[0][:3] == ("a", 0, 20)


# 6 main text

PAGE = """<!DOCTYPE html><html><head><title>T {n}</title><style>p{{}}</style><script>var a="</p>";</script></head><body class="has-sidebar">
<header><a href="/">Site</a></header><nav class=menu><ul><li><a href="/{n}">Menu {n}</a></ul></nav><div class="cookie-notice">We use cookies</div>
<{main}><h1>Title &amp; {n}</h1><p>First {word}
 line&nbsp;here <b>bold</b>text<br>next<p>Second<script>x("<p>no</p>")</script> paragraph {n} is long enough to be the text of the page.
<form><input value=x><label>Search</label></form><aside>Aside {n}</aside><ul><li>one<li>two &lt;b&gt;</ul><div class="ad">Buy {n}</div>
<section id="comments"><p>Reader {n} says</p></section></{main}><footer>&copy; Site {n}</footer></body></html>"""
TEXT = "Title & {n}\nFirst {word} line here boldtext next\nSecond paragraph {n} is long enough to be the text of the page.\none\ntwo <b>"


@pytest.mark.parametrize("main", ["article", "main", "div class=content", "div role=main"])
@pytest.mark.parametrize("pages", [1, 2, 9])
def test_main_text_without_what_stands_around_it(main, pages):
    words = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota"]
    end = main.split()[0]
    sources = [PAGE.replace("</{main}>", f"</{end}>").format(n=i, word=words[i], main=main) for i in range(pages)]
    assert main_text.extract_group(sources) == [TEXT.format(n=i, word=words[i]) for i in range(pages)]


def test_main_text_edges(spark):
    page = PAGE.format(n=1, word="w", main="article")
    rows = [(1, "http://h/", page), (2, "http://h/", None), (3, "http://h/", ""), (4, None, page), (5, "http://h/", page), (5, "http://h/", page)]
    rows += [(6, "http://h/", "just text & more"), (7, "http://h/", "<article>" + "<p>word " * 20000), (8, "http://h/", "<a <b <"), (9, "http://h/", "<p>x</p></div></p><p title='a>b'>y")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"Text": F.lit("old"), "_host2": F.lit(1)})
    got = {r["page_id"]: r["text"] for r in main_text.extract(df).collect()}
    assert main_text.extract(df).count() == len(rows)
    want = TEXT.format(n=1, word="w")
    assert got[1] == got[4] == got[5] == want and got[2] == got[3] == ""
    assert got[6] == "just text & more" and got[7].count("\n") == 19999 and got[9] == "x\ny"
    assert main_text.extract(df.limit(0)).count() == 0


def test_date_is_fixed():
    assert dt.datetime.fromisoformat(warc.DATE)


def test_other_holders_of_its_seeds_do_not_hide_an_edited_passage(spark):
    """Every run that the passage shares with its edited copy stands alone in earlier and in later documents."""
    rng = random.Random(17)
    passage = prose(rng, 60).split()
    edited = [f"new{i}" if i % 10 == 9 else w for i, w in enumerate(passage)]
    runs = [" ".join(passage[i : i + 9]) for i in range(0, 60, 10)]
    alone = lambda start: [(start + i, f"{prose(rng, 40)} {r} {prose(rng, 40)}") for i, r in enumerate(runs)]
    rows = [*alone(0), (100, f"{prose(rng, 40)} {' '.join(passage)} {prose(rng, 40)}"), (101, f"{prose(rng, 40)} {' '.join(edited)} {prose(rng, 40)}"), *alone(200)]
    got = passages.passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [(r["doc_a"], r["doc_b"]) for r in got] == [(100, 101)] and got[0]["n_words"] >= 50


def test_surroundings_are_told_apart():
    s, rng = passages.Settings(), np.random.default_rng(19)
    a = rng.integers(-(2**62), 2**62, 400)
    b = np.concatenate((rng.integers(-(2**62), 2**62, 33), a[100:300], a[:7]))
    at = np.array([0, 30, 80, 120, 195])
    same = passages.near_of(a, at + 100, s) == passages.near_of(b, at + 33, s)
    assert same.tolist() == [False, False, True, True, False]


def test_words_and_sets_go_to_python_in_small_batches(spark, corpus, monkeypatch):
    before, seen = spark.conf.get(common.ARROW_ROWS), []
    written = ngram_join.stable

    def spy(df):
        seen.append(int(spark.conf.get(common.ARROW_ROWS)))
        return written(df)

    monkeypatch.setattr(ngram_join, "stable", spy)
    df = spark.createDataFrame(corpus, "doc_id bigint, text string")
    ngram_join.link_components(df).count()
    assert seen and max(seen) <= 512 and spark.conf.get(common.ARROW_ROWS) == before

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    with common.small_batches(spark):
        most = spark.range(0, 3000, 1, 1).mapInArrow(sizes, "n long").agg({"n": "max"}).first()[0]
    assert most <= 512


def test_links_of_busy_seeds_are_counted_exactly(spark, monkeypatch):
    """In rounds and blocks, against brute force; only what fits is a row of its own."""
    monkeypatch.setattr(passages, "BLOCK", 3)
    monkeypatch.setattr(passages, "ROUND", 0)
    monkeypatch.setattr(passages, "ROUND_LEAST", 40)
    rng = random.Random(8)
    places = {(seed, doc): 7 * seed + doc for seed in range(6) for doc in rng.sample(range(14), 9)}
    busy = spark.createDataFrame([(seed, doc, at, 9) for (seed, doc), at in places.items()], "seed long, doc long, at int, n long")
    links = {(a, b): {(places[s, a], places[s, b]) for s in range(6) if (s, a) in places and (s, b) in places} for a in range(14) for b in range(a + 1, 14)}
    known = {}
    for pair in rng.sample(sorted(links), 40):
        known[pair] = {*rng.sample(sorted(links[pair]), min(1, len(links[pair]))), (1000, rng.randrange(3))}
    pairs = spark.createDataFrame(
        [(a, b, [{"x": x, "y": y} for x, y in at], 0, False, True) for (a, b), at in known.items()],
        "a long, b long, at array<struct<x: int, y: int>>, long long, fits boolean, unjudged boolean",
    )
    got = {(r["a"], r["b"]): r["links"] for r in passages.counted(pairs, busy).collect()}
    want = {p: len(links[p] | known.get(p, set())) for p in links}
    # Beyond three, links of busy seeds alone are counted.
    assert {p: min(n, 4) for p, n in got.items()} == {p: min(n, 4) for p, n in want.items() if n > 3 or p in known}


def test_blocks_of_busy_seeds_find_the_same_passages(spark, monkeypatch):
    rng = random.Random(31)
    line, whole = prose(rng, 12), prose(rng, 70)
    rows = [(i, f"{prose(rng, 70)} {line} {prose(rng, 70)}") for i in range(30)]
    rows += [(100 + i, f"{prose(rng, 20 + i)} {whole} {line} {prose(rng, 40)}") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted(passages.passages(df).collect())
    for name, value in (("BUSY", 2), ("BLOCK", 7), ("ROUND", 0), ("ROUND_LEAST", 100)):
        monkeypatch.setattr(passages, name, value)
    assert sorted(passages.passages(df).collect()) == want
    assert {(r["doc_a"], r["doc_b"]) for r in want} == {(100 + i, 100 + j) for i in range(6) for j in range(i + 1, 6)}


def test_one_place_is_tested_against_many_as_row_by_row():
    s, rng = passages.Settings(), np.random.default_rng(2)
    _, shift, length = passages._reach(s)
    one = rng.integers(0, 256, length, dtype=np.uint8)
    many = rng.integers(0, 256, (80, length + 2 * shift), dtype=np.uint8)
    for i in range(80):
        first = rng.integers(0, 60)
        same = rng.random(60) < i / 80
        part = many[i, first + shift : first + shift + 60]
        part[same] = one[first : first + 60][same]
    want = passages._fits(np.broadcast_to(one, (80, length)), many, s)
    assert passages._fits_one(one, np.ascontiguousarray(many.T), s).tolist() == want.tolist()
    assert 0 < want.sum() < 80


def test_shuffle_files_of_a_step_go_with_it(spark, corpus, monkeypatch):
    before, seen = spark.conf.get(common.CLEANUP), []
    written = passages.stable
    monkeypatch.setattr(passages, "stable", lambda df: (seen.append(spark.conf.get(common.CLEANUP)), written(df))[1])
    df = spark.createDataFrame(corpus, "doc_id bigint, text string")
    passages.remove_passages(df, passages.passage_pairs(df)).count()
    assert len(seen) > 5 and set(seen) == {"true"} and spark.conf.get(common.CLEANUP) == before


def test_pages_are_packed_in_small_batches(spark, tmp_path, monkeypatch):
    before, seen = spark.conf.get(common.ARROW_ROWS), []
    written = warc.stable
    monkeypatch.setattr(warc, "stable", lambda df: (seen.append(int(spark.conf.get(common.ARROW_ROWS))), written(df))[1])
    df = spark.createDataFrame([(i, "u", "x" * 200 + str(i)) for i in range(200)], "page_id bigint, url string, html string")
    assert warc.read_records(warc.write_archives(df, str(tmp_path / "archives"))).count() == 200
    assert seen and max(seen) <= 64 and spark.conf.get(common.ARROW_ROWS) == before


def test_pairs_between_several_parts_are_all_compared(spark, monkeypatch):
    rng = random.Random(41)
    line, whole = prose(rng, 14), prose(rng, 60)
    rows = [(i, f"{prose(rng, 50)} {line} {prose(rng, 50)} {whole if i % 20 == 3 else ''} {prose(rng, 50)}") for i in range(60)]
    rows.append((3, f"{prose(rng, 30)} {whole}"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    words = common.stable(passages.words_of(df, df.select("doc_id")))
    pairs = spark.createDataFrame([(a, b, None) for a in range(60) for b in range(a + 1, 60)], "a long, b long, at array<struct<x: int, y: int>>")
    monkeypatch.setattr(passages, "PART", 1 << 14)
    got = [(r["doc_a"], r["doc_b"]) for r in passages.compared(pairs, words, passages.Settings()).collect()]
    # Document 3 is two rows.
    assert sorted(got) == sorted((a, b) for a, b in [(3, 23), (3, 43), (23, 43)] for _ in range(2 if a == 3 else 1))


def test_no_pair_with_a_passage_is_passed_over():
    """Edited passages of all lengths among words that many texts share; a line alone is told apart."""
    s, rng = passages.Settings(), np.random.default_rng(12)
    some = rng.integers(-(2**31), 2**31, 40)
    loose = lambda n: np.where(rng.random(n) < 0.4, rng.choice(some, n), rng.integers(-(2**31), 2**31, n))
    pack = lambda w: w.astype(np.int32).tobytes() + bytes(len(w))
    kept = lines = passed = 0
    for i in range(300):
        whole = loose(int(rng.integers(50, 140)))
        edited = np.concatenate([[] if e < 0.07 else [w] if e < 0.86 else loose(1) if e < 0.93 else [w, *loose(1)] for w, e in zip(whole, rng.random(len(whole)))]).astype(np.int64)
        line = loose(14)
        a = np.concatenate((loose(80), whole, loose(80), line, loose(80)))
        others = [np.concatenate((loose(60), edited, loose(60))), np.concatenate((loose(200), line, loose(90)))]
        block = passages.Block(pa.table({"doc_id": pa.array([1, 2]), "words": pa.array([pack(o) for o in others], pa.binary())}), s)
        found = [j for j, o in enumerate(others) if passages.shared(a.astype(np.int32), o.astype(np.int32), s)]
        reach = [j for j, _ in block.reaching(a.astype(np.int32), [(0, 0), (1, 1)])]
        assert set(found) <= set(reach)
        kept, lines, passed = kept + len(found), lines + (1 not in found), passed + (1 in reach and 1 not in found)
    assert kept > 100 and passed < lines / 10
    short = passages.Block(pa.table({"doc_id": pa.array([1, 2]), "words": pa.array([pack(loose(n)) for n in (0, 20)], pa.binary())}), s)
    assert short.reaching(loose(60).astype(np.int32), [(0, 0), (1, 1)]) == []


def test_steps_of_the_passages_are_deleted(spark, corpus):
    df = common.stable(spark.createDataFrame(corpus, "doc_id bigint, text string"))
    folder = Path(re.sub("^file:/+", "/", common.work_dir(spark)))
    before = set(folder.iterdir())
    found = passages.passage_pairs(df)
    # What was there stays, and the passages come.
    assert before and before < (after := set(folder.iterdir())) and len(after) == len(before) + 1
    assert found.count() and df.count() == len(corpus)
