"""Corpus operators against brute force on small tables with odd rows."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import time
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tapeflow.llm import attention, chat, decontaminate, extract, jaccard, lines, mixing, quality, urls, warc
from tapeflow.llm.components import components
from tapeflow.llm.queries import ORACLES, QUERIES
from tests.oracle_check import compare, duck

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n):
    return " ".join("".join(rng.choice(["ba", "dé", "ko", "li", "Mu", "né"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    out = [prose(rng, rng.randint(1, 120)) for _ in range(40)]
    shared = prose(rng, 14)
    for i in range(12):  # near copies, a shared line, repeated lines
        words = out[i].split()
        if len(words) > 3:
            words[rng.randrange(len(words))] = "zu"
        out.append(" ".join(words))
        out.append(f"{prose(rng, 30)}\n{shared}\n {shared[:-1]}x\n{prose(rng, 10)}")
    return [*out, None, "", " \n\t", out[0], out[0], "a", "a b", "x " * 3000, "y\n" * 500]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", f"s{i % 4}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, "null id text here", "en", "s1", 3), (3, texts[3], "en", "s3", 4)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def empty_like(spark, frame):
    return spark.createDataFrame([], frame.schema)


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1200)] + [(None, 5)]
    label = {n: n for p in pairs if p[0] is not None for n in p}
    for _ in label:
        changed = False
        for a, b in pairs:
            if a is not None and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
        if not changed:
            break
    edges = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {n: c for n, c in label.items() if any(n in p and p[0] != p[1] for p in pairs if p[0] is not None)}


def test_reply_trees(spark):
    rows = [
        (1, 1, None, "user", "hi ### there</turn> \\ : ok", 0.0), (1, 2, 1, "assistant", "one", 1.0), (1, 3, 1, "assistant", "two", 5.0),
        (1, 4, 2, "user", None, 9.0), (1, 5, 3, "a: b", "", None), (2, 1, 9, "assistant", "orphan", 0.0),
        (3, 1, 2, "user", "ring", 0.0), (3, 2, 1, "user", "ring", 0.0), (3, 3, 2, "user", "tail", 0.0), (1, 5, 3, "a: b", "", None),
    ]
    trees = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    every = chat.read_turns(chat.format_trees(trees, best=5)).collect()
    got = {(r.tree, r.leaf): [(t.role, t.text) for t in r["read"]] for r in every}
    first = ("user", "hi ### there</turn> \\ : ok")
    assert got == {
        (1, 4): [first, ("assistant", "one"), ("user", "")],
        (1, 5): [first, ("assistant", "two"), ("a: b", "")],
        (2, 1): [("assistant", "orphan")],
    }
    best = {r.tree: r.leaf for r in chat.format_trees(trees).collect()}
    assert best == {1: 4, 2: 1}
    assert chat.format_trees(empty_like(spark, trees)).count() == 0
    spans = next(r for r in every if r.leaf == 4)
    assert "".join(spans.formatted[t.text_start : t.text_end] for t in spans.turns if t.loss) == "one"


def test_lm_scores(spark, docs):
    got = attention.lm_scores(docs).collect()
    toks = lambda t: [*WORD.findall((t or "").translate(LOWER)), "\n"]
    given = rows_of(docs)
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    c = collections.Counter(w for d, t in given if not held(d) for w in toks(t))
    n, v = sum(c.values()), len(c)
    want = sorted(
        (d if d is not None else -1, held(d), len(toks(t)), sum(c[w] > 0 for w in toks(t)), n,
         round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in toks(t)), 5))
        for d, t in given
    )
    assert sorted((-1 if r.doc is None else r.doc, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert attention.lm_scores(empty_like(spark, docs)).count() == 0


def test_window_scores_sum_to_one():
    """Over all next ids the factors add up to one, whatever came before."""
    import numpy as np

    rng = np.random.default_rng(0)
    small = lambda *shape: rng.standard_normal(shape).astype(np.float32)
    s, c, w = attention.SLOTS, attention.CLASSES, attention.WIDTH
    model = attention.Model(
        slot=np.arange(s), kind=np.arange(s) % c, log_slot=np.zeros((s, s), np.float32), log_id=np.zeros(s, np.float32),
        query=small(s, w), key=small(s, w), value=small(s, w), out=small(w, c), direct=small(s, c), near=small(attention.WINDOW),
    )
    scorer = attention.Scorer(model, 5)
    stream = rng.integers(0, s, 70)
    last = []
    for k in range(c):  # one id of each class stands for the class
        ids = np.append(stream, k)
        last.append(10 ** float(attention.score_streams(scorer, ids, np.array([0, len(ids)]))[0]))
    before = 10 ** float(attention.score_streams(scorer, stream, np.array([0, len(stream)]))[0])
    assert abs(sum(last) / before - 1) < 1e-3


def test_decontamination_by_broadcast_and_by_join(spark, docs, texts):
    items = [(1, texts[5]), (2, "A b"), (3, None), (4, "--"), (5, texts[45]), (None, "zu")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    grams = collections.defaultdict(set)
    for item, text in items:
        w = word.findall((text or "").translate(LOWER))
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if size else 0):
            grams[tuple(w[i : i + size])].add(item)
    want = []
    for d, t in rows_of(docs):
        w, hit, found = word.findall((t or "").translate(LOWER)), set(), set()
        for size in {len(g) for g in grams}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in grams:
                    hit |= set(range(i, i + size))
                    found |= {str(x) for x in grams[tuple(w[i : i + size])] if x is not None}
        want.append((str(d), len(w), len(hit), sorted(found)))
    for bound in (decontaminate.BROADCAST_BYTES, 0):
        got = decontaminate.find(docs, benchmark, broadcast_bytes=bound).collect()
        assert sorted((str(r.doc_id), r.hits.n_words, r.hits.n_hit, r.hits["items"]) for r in got) == sorted(want)
    left = decontaminate.remove_spans(docs, benchmark)
    assert left.count() == docs.count()
    assert decontaminate.find(docs, empty_like(spark, benchmark)).filter("hits.n_hit > 0").count() == 0
    assert decontaminate.find(empty_like(spark, docs), benchmark).count() == 0


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def near_lines(a, b):
    shorter = min(len(a), len(b))
    limit = min(31, max(1 if shorter < 40 else 2, shorter * 2 // 100))
    return abs(len(a) - len(b)) <= limit and levenshtein(a, b) <= limit


def test_line_dedup(spark, docs):
    given = sorted({(d is None, d or 0, t) for d, t in rows_of(docs) if t is not None})
    line = [(none, d, t, i, x.strip(" \t\n\r\x0b\x0c")) for none, d, t in given for i, x in enumerate(t.split("\n"))]
    distinct = sorted({x[4] for x in line if len(x[4]) >= lines.FLOOR_CHARS})
    label = {x: x for x in distinct}
    links = [(a, b) for a in distinct for b in distinct if a < b and near_lines(a, b)]
    for _ in distinct:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert links
    seen, want = set(), collections.defaultdict(list)
    for none, d, t, i, x in line:
        if x in label:
            if label[x] in seen:
                want[(none, d, t)].append(i)
            seen.add(label[x])
    got = lines.dedup_lines(docs).collect()
    text_of = dict(rows_of(docs))
    assert len(got) == docs.count()
    removed = sum(len(r.removed_lines) for r in got if r.doc_id != 3)
    assert removed == sum(len(v) for (none, d, t), v in want.items() if d != 3 or none)
    for r in got:
        if r.doc_id is not None and r.doc_id != 3 and text_of[r.doc_id] is not None:
            all_lines = text_of[r.doc_id].split("\n")
            assert r.text == "\n".join(x for i, x in enumerate(all_lines) if i not in r.removed_lines)
    assert lines.dedup_lines(empty_like(spark, docs)).count() == 0
    with pytest.raises(ValueError, match="rename"):
        lines.dedup_lines(docs.withColumn("removed_lines", F.lit(1)))


def edited(rng, line, edits, kinds="idr"):
    out = list(line)
    for _ in range(edits):
        kind, at = rng.choice(kinds), rng.randrange(len(out))
        if kind == "i":
            out.insert(at, "z")
        elif kind == "d":
            out.pop(at)
        else:
            out[at] = "y"
    return "".join(out).strip()


def test_line_dedup_by_share(spark):
    """Lines may differ in a share of their characters."""
    rng = random.Random(9)
    made = []
    for _ in range(70):
        line = prose(rng, rng.randint(5, 160))
        made.append(line)
        for _ in range(rng.randint(0, 2)):
            edits = int(lines.limits(lines.np.array([len(line)]))[0]) + rng.choice([0, 0, 1])
            made.append(edited(rng, line, edits, rng.choice(["i", "d", "r", "idr"])))
    rng.shuffle(made)
    label = list(range(len(made)))
    links = [(i, j) for j, b in enumerate(made) for i, a in enumerate(made[:j]) if min(len(a), len(b)) >= 20 and near_lines(a, b)]
    assert len([1 for i, j in links if levenshtein(made[i], made[j]) > 2]) > 20
    for _ in made:
        for i, j in links:
            label[i] = label[j] = min(label[i], label[j])
    frame = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").repartition(3)
    for chars, pairs, few in ((lines.GROUP_CHARS, lines._ALL_PAIRS, lines._FEW_LINES), (3000, 0, 8192), (lines.GROUP_CHARS, 0, 0)):
        with pytest.MonkeyPatch.context() as patch:
            for name, value in (("GROUP_CHARS", chars), ("_ALL_PAIRS", pairs), ("_FEW_LINES", few)):
                patch.setattr(lines, name, value)
            got = lines.dedup_lines(frame).collect()
        assert sorted(r.doc_id for r in got if not r.removed_lines) == sorted(set(label))


@pytest.mark.parametrize(("low", "high", "kinds"), [(20, 60, "idr"), (20, 60, "i"), (40, 300, "d"), (140, 700, "idr"), (1400, 5000, "idr"), (1500, 1600, "i")])
def test_segments_of_near_lines_meet(low, high, kinds):
    """Lines that differ by their limit share a key that one of them is indexed under, and are
    found to be that near."""
    rng = random.Random(low + high)
    made = []
    for _ in range(40 if low > 1000 else 300):
        line = "".join(rng.choice("abcdé ") for _ in range(rng.randint(low, high)))
        line = line.strip().ljust(low, "q")
        limit = int(lines.limits(lines.np.array([len(line) - (len(line) // 40 if "d" in kinds else 0)]))[0])
        made += [line, edited(rng, line, limit, kinds).ljust(low, "q")]
    code = lines.np.frombuffer("".join(made).encode("utf-32-le"), lines.np.uint32)
    at = lines.np.cumsum([0, *map(len, made)])
    hasher = lines.Hasher()
    start, end = at[:-1], at[1:]
    a, b = (start[::2], end[::2]), (start[1::2], end[1::2])
    limit = lines.limits(lines.np.minimum(a[1] - a[0], b[1] - b[0]))
    near = lines.edits_within(code, hasher.sums(code), hasher, a, b, limit)
    few = 3 if low > 1000 else 60
    plain = [levenshtein(x, y) <= k for x, y, k in zip(made[: 2 * few : 2], made[1 : 2 * few : 2], limit[:few], strict=True)]
    assert near[:few].tolist() == plain and near.sum() > len(near) // 2
    keys, own = collections.defaultdict(set), collections.defaultdict(set)
    for which, key, indexed in lines.segment_keys(hasher, hasher.sums(code), start, end):
        for line, k, is_own in zip(which.tolist(), key.tolist(), indexed.tolist(), strict=True):
            keys[line].add(k)
            if is_own:
                own[line].add(k)
    for i in lines.np.flatnonzero(near).tolist():
        assert keys[2 * i] & own[2 * i + 1] or own[2 * i] & keys[2 * i + 1]


def test_edits_of_random_spans():
    """Distances around their limit, of texts with few letters."""
    rng = random.Random(13)
    made = []
    for _ in range(400):
        line = "".join(rng.choice("ab") for _ in range(rng.randint(12, 70)))
        made += [line, edited(rng, line, rng.randint(0, 9))]
    code = lines.np.frombuffer("".join(made).encode("utf-32-le"), lines.np.uint32)
    at = lines.np.cumsum([0, *map(len, made)])
    hasher = lines.Hasher()
    a, b = (at[:-1][::2], at[1:][::2]), (at[:-1][1::2], at[1:][1::2])
    within = lines.np.array([rng.choice([1, 2, 3, 4, 7, 11, 12, 31]) for _ in range(400)])
    got = lines.edits_within(code, hasher.sums(code), hasher, a, b, within)
    assert got.tolist() == [levenshtein(x, y) <= k for x, y, k in zip(made[::2], made[1::2], within, strict=True)]


def test_distances_of_long_spans_by_pieces():
    """Long lines with edits far apart, near their limit, repetitive ones too."""
    rng = random.Random(21)
    hasher = lines.Hasher()
    for letters in ("abcdefgh ", "ab"):
        made, limit = [], []
        for _ in range(14):
            line = "".join(rng.choice(letters) for _ in range(rng.randint(1100, 2500)))
            within = rng.choice([14, 20, 31])
            made += [line, edited(rng, line, within + rng.choice([-4, 0, 1, 3]))]
            limit.append(within)
        made += ["xy" * 800, "xy" * 795 + "yx" * 4, "q" * 1600, "q" * 1590]
        limit += [31, 31]
        code = lines.np.frombuffer("".join(made).encode("utf-32-le"), lines.np.uint32)
        at = lines.np.cumsum([0, *map(len, made)])
        a, b = (at[:-1][::2], at[1:][::2]), (at[:-1][1::2], at[1:][1::2])
        got = lines.edits_within(code, hasher.sums(code), hasher, a, b, lines.np.array(limit))
        assert got.tolist() == [levenshtein(x, y) <= k for x, y, k in zip(made[::2], made[1::2], limit, strict=True)]
        assert 3 < got.sum() < len(got)


def test_few_edits_of_long_lines_take_no_look_at_each_character():
    """Pairs cost their edits, not their length, also in calls of one pair; both answers are right."""
    rng = random.Random(8)
    hasher, took = lines.Hasher(), 0.0
    for n in range(120):
        line = "".join(rng.choice("abcdefgh ") for _ in range(1000))
        other = edited(rng, line, 20 if n % 2 else 24)
        code = lines.np.frombuffer((line + other).encode("utf-32-le"), lines.np.uint32)
        sums, end = hasher.sums(code), lines.np.array([1000, len(code)])
        began = time.process_time()
        got = lines.edits_within(code, sums, hasher, (end[:1] * 0, end[:1]), (end[:1], end[1:]), lines.np.array([20]))
        took += time.process_time() - began
        if n < 6:
            assert got.tolist() == [levenshtein(line, other) <= 20]
    assert took < 1.2


def test_edits_that_collect_in_one_half():
    """All edits in the first or the last half of a line leave a segment in the other."""
    rng = random.Random(2)
    hasher = lines.Hasher()
    for length in (45, 150, 333, 1600):
        line = "".join(rng.choice("abcdefgh") for _ in range(length))
        limit = int(lines.limits(lines.np.array([length]))[0])
        near = ["z" * limit + line, line + "z" * limit, edited(rng, line[: length // 2], limit, "i") + line[length // 2 :],
                line[: length // 2] + edited(rng, line[length // 2 :], limit, "i")]
        made = [line, *near]
        code = lines.np.frombuffer("".join(made).encode("utf-32-le"), lines.np.uint32)
        at = lines.np.cumsum([0, *map(len, made)])
        keys, own = collections.defaultdict(set), set()
        for which, key, indexed in lines.segment_keys(hasher, hasher.sums(code), at[:-1], at[1:]):
            for i, k, is_own in zip(which.tolist(), key.tolist(), indexed.tolist(), strict=True):
                keys[i].add(k)
                if is_own and i == 0:
                    own.add(k)
        assert all(keys[i] & own for i in range(1, 5))


def test_keys_of_a_line_are_about_as_many_as_its_segments():
    """What is shuffled for a line depends neither on its moves nor on how many other lines there are."""
    rng = random.Random(5)
    made = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(200, 2500))).strip() for _ in range(300)]
    code = lines.np.frombuffer("".join(made).encode("utf-32-le"), lines.np.uint32)
    at = lines.np.cumsum([0, *map(len, made)])
    hasher = lines.Hasher()
    found = [indexed for _, _, indexed in lines.segment_keys(hasher, hasher.sums(code), at[:-1], at[1:])]
    indexed = lines.np.concatenate(found)
    assert len(indexed) < 3.5 * indexed.sum()


def test_lines_with_one_passage_in_common_are_not_tied(spark):
    """A passage at the same place makes lines neither a cluster nor, for many, a comparison of all with all;
    lines that are near stay tied, whatever way the lines of a key are compared."""
    rng = random.Random(6)
    start = "the same forty-six characters begin every line "
    made = [start + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(204)) for _ in range(150)]
    near = [edited(rng, line, 4) for line in made[:30]]
    frame = spark.createDataFrame(list(enumerate(made + near)), "doc_id long, text string").repartition(4)
    want = list(range(150))
    ties = lines._ties(frame, "text", lines.SHARE).distinct().count()
    assert 0 < ties <= 90
    for few, full in ((lines._FEW, lines._IN_FULL), (1, 1 << 13), (1, 4), (1 << 13, 1 << 13)):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(lines, "_FEW", few)
            patch.setattr(lines, "_IN_FULL", full)
            got = lines.dedup_lines(frame).collect()
        assert sorted(r.doc_id for r in got if not r.removed_lines) == want


def test_alike_is_never_false_for_near_lines():
    rng = random.Random(7)
    made = []
    for _ in range(400):
        line = "".join(rng.choice("abcdeé\U0001f600 ") for _ in range(rng.randint(20, 2500)))
        made += [line, edited(rng, line, int(lines.limits(lines.np.array([len(line)]))[0]), rng.choice(["i", "d", "r", "idr"]))]
    code = lines.np.frombuffer("".join(made).encode("utf-32-le"), lines.np.uint32)
    at = lines.np.cumsum([0, *map(len, made)])
    a, b = (at[:-1][::2], at[1:][::2]), (at[:-1][1::2], at[1:][1::2])
    limit = lines.limits(lines.np.minimum(a[1] - a[0], b[1] - b[0]))
    hasher = lines.Hasher()
    near = lines.edits_within(code, hasher.sums(code), hasher, a, b, limit)
    look = lines._look(code, at[:-1], at[1:])
    assert near.sum() > 250 and lines._alike(look[::2], look[1::2], lines.SHARE)[near].all()
    assert lines._alike(look[:-2:2], look[2::2], lines.SHARE).sum() < 5


def test_quality_measures(spark, docs):
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(60)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    ratio, threshold = quality.fit(docs, labels)
    got = quality.judge(docs, ratio, threshold).collect()
    for r in got:
        t = r.text or ""
        w, q = WORD.findall(t), r.quality_of
        split = [x for x in t.split("\n") if WORD.search(x)]
        windows = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        repeated = {i + j for i in range(len(w) - 2) for j in range(3) if windows[tuple(w[i : i + 3])] > 1}
        want = (len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), len(split) - len(set(split)), len(repeated))
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == want
        assert q.base_failed == (len(w) < 50 or 100 * len(repeated) > 50 * len(w))
        assert q.kept == (not q.base_failed and q.score >= threshold)
    assert len(got) == docs.count()
    ratio, threshold = quality.fit(docs, empty_like(spark, labels))
    assert not ratio.any() and quality.judge(empty_like(spark, docs), ratio, threshold).count() == 0


def test_warc_round_trip(spark, path):
    rng = random.Random(2)
    big = [prose(rng, 400) for _ in range(5)]
    rows = [(i, f"http://h/{i}" if i % 3 else None, t) for i, t in enumerate([*big, big[0], big[0], "small", "small", None, "", "é\r\n\r\nWARC/1.1\r\n"])]
    rows += [(None, "x y", big[1]), (6, "http://again", big[0])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    warc.write_archives(warc.mark_revisits(pages), path("raw"))
    index = warc.normalise(spark, path("raw"), path("warc"))
    got = [(r.record_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.read_records(index).collect()]
    want = []
    for i, _, t in rows:
        raw = (t or "").encode()
        same = [j for j, _, u in rows if u == t and j is not None]
        revisit = len(raw) >= 1000 and len([1 for _, _, u in rows if u == t]) > 1 and i != max(same)
        name = "<urn:page:%s>" % ("" if i is None else i)
        want.append((name, "revisit" if revisit else "response", f"<urn:page:{max(same)}>" if revisit else None, len(raw), hashlib.sha1(raw).hexdigest()))
    assert sorted(got, key=str) == sorted(want, key=str)
    with open(index.first().archive, "rb") as file:  # each member stands alone
        row = index.first()
        file.seek(row.offset)
        assert zlib.decompress(file.read(row.length), 31).startswith(b"WARC/1.1")


def test_mix(spark, docs):
    planned = mixing.plan(docs).collect()
    size = lambda t: len(WORD.findall(t or ""))
    sources = sorted({r.source for r in planned if r.source is not None}) + [None]
    total = {s: sum(size(r.text) for r in planned if r.source == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    full = set()
    while True:
        rest = [s for s in sources if s not in full]
        left = (1.5 * sum(total.values()) - sum(2 * total[s] for s in full)) / sum(weight[s] for s in rest)
        more = {s for s in rest if left * weight[s] > 2 * total[s]}
        if not more:
            break
        full |= more
    for s in sources:
        own = [r for r in planned if r.source == s]
        want = 2 * total[s] if s in full else left * weight[s]
        taken = sum(r.size * len(r.draws) for r in own)
        assert all(abs(r.target - want) < 1e-6 * want and r.source_size == total[s] and r.size == size(r.text) for r in own)
        assert all(len({d.copy for d in r.draws}) == len(r.draws) <= 2 for r in own)
        assert abs(taken - want) <= max(r.size for r in own) / 2
    assert sorted(map(str, planned)) == sorted(map(str, mixing.plan(docs.repartition(3)).collect()))
    mixed = mixing.mix(docs)
    assert mixed.count() == sum(len(r.draws) for r in planned)
    assert mixing.mix(empty_like(spark, docs)).count() == 0


def test_mix_meets_its_target_beside_a_long_document(spark):
    """A miss of half the smallest document left out at most, beside a long one."""
    for small, long_one in ((200, 6000), (40, 900), (3, 5000)):
        sizes = [20 + i % 3 for i in range(small)] + [long_one]
        rows = [(i, "x " * n, "a", n) for i, n in enumerate(sizes)] + [(1000 + i, "y " * 37, "b", 37) for i in range(90)]
        rows += [(2000 + i, "z", None, 1) for i in range(30)]
        made = spark.createDataFrame(rows, "doc_id long, text string, source string, salt long")
        planned = mixing.plan(made).collect()
        for source in ("a", "b", None):
            own = [r for r in planned if r.source == source]
            left = [r.size for r in own if not r.draws] or [r.size for r in own if len(r.draws) < 2]
            # with all taken as often as they may be, the last one taken may lie across the target
            bound = min(left) if left else max(r.size for r in own)
            assert abs(sum(r.size * len(r.draws) for r in own) - own[0].target) <= bound / 2


def test_mix_columns_that_clash(spark, docs):
    odd = docs.select("doc_id", "text", "source", *[F.lit(c).alias(c) for c in ("place", "before", "given", "row_id", "Shard", "size", "draws", "gap")])
    planned = mixing.plan(odd)
    assert planned.columns == ["doc_id", "text", "source", "place", "before", "given", "row_id", "Shard", "gap", "size", "source_size", "target", "draws"]
    mixed = mixing.mix(odd)
    assert mixed.columns == ["doc_id", "text", "source", "place", "before", "given", "row_id", "size", "draws", "gap", "shard", "copy", "mix_block"]
    rows = mixed.collect()
    assert len(rows) == planned.select(F.sum(F.size("draws"))).first()[0] > 0
    assert {(r["size"], r.place, r.row_id) for r in rows} == {("size", "place", "row_id")}


def test_columns_that_clash(spark, docs):
    """Given columns keep their names and values; those named as an added one give way to it."""
    names = ["hits", "Row_Key", "known", "quality_of", "doc", "text_key", "removed", "line_count", "u", "t", "lists", "main_text"]
    odd = docs.select("*", *[F.lit(f"given {c}").alias(c) for c in names])
    items = spark.createDataFrame([("i", docs.filter("doc_id = 30").first().text)], "item_id string, text string")
    labels = docs.filter("doc_id IS NOT NULL").selectExpr("doc_id", "cast(doc_id % 2 as int) quality")
    ratio, threshold = quality.fit(odd, labels)
    changes = spark.createDataFrame([], "list string, pattern string, action string, changed_at timestamp, listed boolean")
    captures = odd.selectExpr("*", "'http://a.b/' url", "timestamp'2024-01-01' fetched_at")
    runs = {
        "find": (lambda d: decontaminate.find(d, items), ["hits"]),
        "meet": (lambda d: decontaminate.find(d, items, broadcast_bytes=0), ["hits"]),
        "clean": (lambda d: decontaminate.remove_documents(d, items), []),
        "spans": (lambda d: decontaminate.remove_spans(d, items), []),
        "judge": (lambda d: quality.judge(d, ratio, threshold), ["quality_of"]),
        "good": (lambda d: quality.keep_good(d, ratio, threshold), []),
        "lines": (lambda d: lines.dedup_lines(d), ["line_count", "removed_lines"]),
        "one": (jaccard.keep_one, []),
        "extract": (lambda d: extract.extract(d, "text"), ["main_text"]),
        "urls": (lambda d: urls.evaluate(d, changes), list(urls._ADDED)),
    }
    for run, added in runs.values():
        given = captures if added == list(urls._ADDED) else odd
        plain = run(given.drop(*names))
        got = run(given)
        assert sorted(got.columns) == sorted({*given.columns, *added})
        assert sorted(map(str, got.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
        for c in {*names} - {*added}:
            assert got.filter(F.col(c).eqNullSafe(f"given {c}")).count() == got.count() > 0


def test_split_tree(spark):
    quotas = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 0), ("d", 333)], "source_key string, blocks long")
    ends = {r.source_key: r.ends for r in mixing.split_tree(quotas, 3).collect()}
    assert {k: e[-1] for k, e in ends.items()} == {"a": 1000, "b": 10, "c": 0, "d": 333}
    shards = [sum(e[i] - (e[i - 1] if i else 0) for e in ends.values()) for i in range(8)]
    assert max(shards) - min(shards) <= 1 and all(list(e) == sorted(e) for e in ends.values())


def test_mix_plan_stays_small(spark):
    """The driver plans the splitting tree and the fills without copies of what is used twice."""
    quotas = spark.createDataFrame([("a", 300), ("b", 0), ("n", 17)], "source_key string, blocks long")
    ends = {r.source_key: r.ends for r in mixing.split_tree(quotas).collect()}
    assert {k: (len(v), v[-1]) for k, v in ends.items()} == {"a": (16, 300), "b": (16, 0), "n": (16, 17)}
    plan = mixing.split_tree(quotas)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 50_000



@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 50)])
def test_jaccard(spark, docs, n, percent):
    given = rows_of(docs)
    sets = []
    for _, t in given:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    label = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if i != j and a and 100 * len(a & b) >= percent * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    least = {}
    for (d, _), g in zip(given, label, strict=True):
        if d is not None:
            least[g] = min(least.get(g, d), d)
    want = sorted((str(d), len(s), least.get(g)) for (d, _), s, g in zip(given, sets, label, strict=True))
    got = jaccard.similar(docs, n=n, percent=percent).collect()
    assert sorted((str(r.doc), r.n_shingles, r.component_id) for r in got) == want
    kept = jaccard.keep_one(docs, n=n, percent=percent)
    wordless = [x for x, s in zip(given, sets, strict=True) if not s]
    assert kept.columns == docs.columns and kept.count() == len({g for g, s in zip(label, sets, strict=True) if s}) + len(set(wordless))
    assert jaccard.similar(empty_like(spark, docs)).count() == 0


@pytest.mark.parametrize(("percent", "most", "seed"), [(80, 20, 3), (85, 60, 2), (85, 100, 1)])
def test_jaccard_at_the_bound(spark, percent, most, seed):
    """Pairs of sets that have just enough in common, each linked with nothing else."""
    rng = random.Random(seed)
    rows = []
    while len(rows) < 6000:
        small = rng.randint(5, most)
        large = rng.randint(small, small * 100 // percent)
        common = -(-percent * (small + large) // (100 + percent))
        if common > small:
            continue
        words = [f"w{rng.getrandbits(40)}" for _ in range(small + large - common)]
        rows.append((len(rows), " ".join(words[:small])))
        rows.append((len(rows), " ".join(words[:common] + words[small:])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc: r.component_id for r in jaccard.similar(frame, n=1, percent=percent).collect()}
    assert [i for i in got if got[i] != i // 2 * 2] == []


def test_jaccard_in_chunks(spark, docs, monkeypatch):
    whole = sorted(jaccard.similar(docs, percent=50).collect(), key=str)
    monkeypatch.setattr(jaccard, "GROUP_SHINGLES", 150)
    assert sorted(jaccard.similar(docs, percent=50).collect(), key=str) == whole


def test_url_filters(spark):
    ts = lambda s: f"2024-01-{s:02d} 00:00:00"
    caps = [(1, "HTTP://u@A.Example.com.:80/x/y?q", 5), (2, "http://example.com/x", 20), (3, "b/c", 5), (4, None, 5), (5, "http://example.com/", None), (1, "HTTP://u@A.Example.com.:80/x/y?q", 5)]
    captures = spark.createDataFrame([(i, u, ts(d) if d else None) for i, u, d in caps], "page_id long, url string, t string")
    captures = captures.select("page_id", "url", F.to_timestamp("t").alias("fetched_at"))
    steps = [("l", "example.com", "block", 1, True), ("l", "example.com", "block", 10, False), ("ok", "a.example.com/x", "allow", 2, True), ("l", "example.com", "block", 21, True), (None, "com", "block", 1, True), ("l2", "com", "block", 20, None)]
    changes = spark.createDataFrame([(a, b, c, ts(d), e) for a, b, c, d, e in steps], "list string, pattern string, action string, t string, listed boolean")
    changes = changes.select("list", "pattern", "action", F.to_timestamp("t").alias("changed_at"), "listed")
    got = sorted((r.page_id, r.url_host, r.n_active, r.lists, r.verdict) for r in urls.evaluate(captures, changes).collect())
    assert got[:2] == [(1, "a.example.com", 2, "l,ok", "allow")] * 2
    assert [g[2:] for g in got[2:]] == [(0, "", "none")] * 4
    assert urls.evaluate(captures, empty_like(spark, changes)).filter("verdict = 'none'").count() == 6
    assert urls.evaluate(empty_like(spark, captures), changes).count() == 0


def test_main_text(spark):
    page = """<html><body><div id=nav><a href=/>Home, sweet, home</a></div><div class="content"><h1>A &amp; B</h1>
      <p>First, a <b>bold</b>   word,<br>then more text, and more, and more &eacute;.<p>Second paragraph, which is long enough, too.
      <div class="share-buttons"><p>Tweet, this, now</p></div><script>x("<p>no</p>")</script></div>
      <aside><p>Side, note, with, commas, and, more, commas</p></aside><div id="comments"><p>Reader, writes, many, commas, here, too</p></div></body></html>"""
    want = "A & B\nFirst, a bold word, then more text, and more, and more é.\nSecond paragraph, which is long enough, too."
    assert extract.main_text(page) == want
    odd = ["", "plain text", "<p>unclosed <", "<div>" * 3000 + "deep" + "</div>" * 3000, "<!-- never ends", "</p></div>x", None]
    frame = spark.createDataFrame([(i, "u", p) for i, p in enumerate([page, *odd])], "page_id long, url string, html string")
    got = {r.page_id: r.main_text for r in extract.extract(frame).collect()}
    assert got[0] == want and got[2] == "plain text" and got[4] == "deep" and got[7] == "" and len(got) == 8
    assert extract.extract(empty_like(spark, frame)).count() == 0


def _laid_out(rng, layout):
    """A page and the article's blocks, with things around it that are not the article."""
    heading, blocks = prose(rng, 6), [prose(rng, rng.randint(25, 70)) + ", " + prose(rng, 20) for _ in range(rng.randint(3, 6))]
    inner = f"<h1>{heading}</h1>" + "".join(f"<p>{b}</p>" for b in blocks)
    links = "".join(f'<li><a href="/{i}">{prose(rng, 3)}</a></li>' for i in range(8))
    around = [f"<nav><ul>{links}</ul></nav>", f'<div class="cookie-consent">{prose(rng, 40)}, {prose(rng, 9)}</div>']
    after = [
        f'<aside>{prose(rng, 30)}</aside><form><p>{prose(rng, 30)}, {prose(rng, 8)}</p><input name=q></form>',
        f'<section class="comments"><article class="comment"><p>{prose(rng, 60)}, {prose(rng, 9)}</p></article></section>',
        f"<footer>{prose(rng, 12)}</footer><script>a(\"<p>{prose(rng, 9)}</p>\")</script>",
    ]
    rng.shuffle(around)
    rng.shuffle(after)
    half = len(inner) // 2
    cut = inner.find("<p>", half) if "<p>" in inner[half:] else len(inner)
    body = {
        "article": f"<article>{inner}</article>",
        "main": f"<main><div>{inner}</div></main>",
        "named": f'<div id="page"><div class="post-content">{inner}</div></div>',
        "plain": f"<div><div>{inner}</div></div>",
        "parts": f"<article><section>{inner[:cut]}</section><section>{inner[cut:]}</section></article>",
        "teaser": f"<article><a href=/x>{prose(rng, 12)}</a></article><div class=story>{inner}</div>",
        "deep": "<article>" + "<div>" * 9 + inner + "</div>" * 9 + "</article>",
    }[layout]
    page = f"<html><head><title>{heading}</title></head><body>{''.join(around)}{body}{''.join(after)}</body></html>"
    return page, "\n".join([heading, *blocks])


@pytest.mark.parametrize("layout", ["article", "main", "named", "plain", "parts", "teaser", "deep"])
def test_main_text_of_layouts(layout):
    """The text put in comes out, whether the page names its article or not."""
    for seed in range(8):
        page, want = _laid_out(random.Random(seed), layout)
        assert extract.main_text(page) == want, (layout, seed)


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    given, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, given, sf).cache()
        if name != "mix_sources":
            assert after.columns == columns
            assert 0 < after.count() <= given.count()
        given = after
    assert set(columns) < set(given.columns) and given.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    sf = "/root/testdata/sf0.001"
    assert compare(spark, duck(sf), name, QUERIES[name], ORACLES[name], sf) is None


def test_quality_threshold_whatever_the_partitions(spark):
    """The exact quantiles of the held-out labels, in whatever partitions they come."""
    n, lengths = 100_000, F.pmod(F.xxhash64("doc_id"), F.lit(97)) + 1
    docs = spark.range(n).toDF("doc_id").withColumn("text", F.expr("concat_ws(' ', transform(sequence(1, cast(pmod(xxhash64(doc_id), 13) as int) + 1), i -> hex(pmod(xxhash64(doc_id, i), 400))))"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), (F.pmod(lengths, F.lit(3)) > 0).cast("int").alias("quality"))
    thresholds = set()
    for parts in (1, 7, 40):
        ratio, threshold = quality.fit(docs.repartition(parts), labels)
        thresholds.add(threshold)
    held = quality.measured(docs, ratio, "text", keep_text=False).join(labels, "doc_id").filter(
        F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(quality.FOLDS)) == 0
    )
    rows = [(r.quality, r.quality_of.score) for r in held.collect()]

    def quantile(scores, share):
        scores, at = sorted(scores), share * (len(scores) - 1)
        low = math.floor(at)
        return scores[low] + (at - low) * (scores[min(low + 1, len(scores) - 1)] - scores[low])

    low = quantile([s for good, s in rows if good], 1 - quality.KEPT)
    high = quantile([s for good, s in rows if not good], quality.KEPT)
    want = low if high > low else (low + high) / 2
    assert len(thresholds) == 1 and math.isclose(thresholds.pop(), want, rel_tol=1e-9)


@pytest.mark.parametrize(
    "part, times, more, text",
    [
        ("<a ", 3_000_000, "", None),  # tags that never end are text
        ("<a ", 3_000_000, '"', None),
        ("<a \"'", 1_000_000, "", None),
        ("<!x", 3_000_000, "", None),
        ("<a ", 1_000_000, ">end", "end"),
        ("<b>", 300_000, "</i>" * 300_000 + "end", "end"),
        ("<div>x", 100_000, "", "\n".join("x" * 100_000)),
    ],
)
def test_long_odd_pages_in_linear_time(part, times, more, text):
    """Time per part must not grow with their number: a tenth of the page costs a tenth, about."""
    page = part * times + more
    start = time.perf_counter()
    assert extract.main_text(page) == (page.strip() if text is None else text)
    assert time.perf_counter() - start < 20


def test_ends_of_tags():
    """Against plain scanning of each tag from its name on."""
    def plain(page, at):
        quote = None
        for i in range(at, len(page)):
            if quote is None and page[i] == ">":
                return i + 1
            if page[i] in "\"'" and quote in (None, page[i]):
                quote = page[i] if quote is None else None
        return -1

    rng = random.Random(8)
    for _ in range(3000):
        page = "".join(rng.choice("\"'>ab") for _ in range(rng.randint(1, 14)))
        tags = extract.Tags(page)
        for at in range(len(page)):
            assert tags.end(at) == plain(page, at), (page, at)
        places = sorted(rng.randrange(len(page)) for _ in range(5))
        again = extract.Tags(page)
        assert [again.end(at) for at in places] == [plain(page, at) for at in places]


def test_every_label_counts(spark, monkeypatch):
    """Labels beyond the number that was once a limit, and repeated or null keys of documents."""
    monkeypatch.setattr(quality, "MOST_LABELS", 10, raising=False)
    rows = [(i, "w%d x%d" % (i % 7, i % 3)) for i in range(300)] + [(5, "twice y"), (None, "none z"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(300)] * 2 + [(None, 1)], "doc_id long, quality int")
    held = {r.doc_id for r in labels.filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(quality.FOLDS)) == 0).collect()}
    trusted = [t for d, t in rows if d is not None and d % 4 and d not in held]
    texts = lambda kept: spark.createDataFrame([(t,) for t in kept], "text string")
    raw, target = quality.gram_counts(texts(t for _, t in rows))[0], quality.gram_counts(texts(trusted))[0]
    ratio, threshold = quality.fit(docs, labels)
    assert (ratio == quality.log_ratio(target, raw)).all()
    assert math.isfinite(threshold)


@pytest.mark.parametrize("n", [1, 2, 3, 150, 5000])
@pytest.mark.parametrize("at", [0.01, 0.5, 0.99])
def test_exact_quantile(spark, n, at):
    scores = spark.range(n).select((F.pmod(F.xxhash64("id"), F.lit(n)) / 7).alias("score"))
    assert quality._quantile(scores, at) == scores.agg(F.percentile("score", F.lit(at))).first()[0]
    assert quality._quantile(scores.limit(0), at) is None


def test_all_ids_train(spark):
    """Every id of every training text is in one run, after the id before it, in one round."""
    rng = random.Random(4)
    given = [None, "", " ", "One", *[" ".join(rng.choice(["aa", "Bcd", "\u00e9x", "zq9z"]) for _ in range(rng.randint(1, 400))) for _ in range(20)]]
    with open(attention.TOKENIZER, "rb") as file:
        ranks = file.read()
    coder = attention.Subwords(ranks)
    want = []
    for t in given:
        ids = [*coder.encode([w.encode() for w in (t or "").lower().split()])[0].tolist(), coder.end]
        for low in range(0, len(ids), attention.WINDOW):
            want.append([ids[low - 1] if low else coder.end, *ids[low : low + attention.WINDOW]])
    rows = spark.createDataFrame([(t,) for t in given], "text string")
    sent = spark.sparkContext.broadcast(ranks)
    got = attention.gather(rows, "text", sent).filter("ids IS NOT NULL").collect()
    assert sorted(r.ids for r in got) == sorted(want)
    assert {r.c for r in got} == set(range(attention.ROUNDS))


def test_training_runs_as_one_value_each(spark):
    """The job writes the ids of a run as bytes, not as a number each; they are the same ids."""
    rng = random.Random(6)
    given = [None, "", "One", "x" * 700, *[" ".join(rng.choice(["aa", "Bcd", "\u00e9x", "zq9z"]) for _ in range(rng.randint(1, 300))) for _ in range(20)]]
    with open(attention.TOKENIZER, "rb") as file:
        ranks = file.read()
    end = attention.Subwords(ranks).end
    rows = spark.createDataFrame([(t,) for t in given], "text string")
    sent = spark.sparkContext.broadcast(ranks)
    want = attention.gather(rows, "text", sent).filter("ids IS NOT NULL").select("ids").collect()
    packed = attention.gather(rows, "text", sent, as_bytes=True).filter("ids IS NOT NULL").select("ids").toArrow()
    got = []
    for column in packed.column("ids").chunks:
        flat, at = attention._unpacked(column, end)
        got += [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert sorted(got) == sorted(r.ids for r in want)
    # a number of two bytes for each id
    assert attention._number(end) == attention.np.uint16 and attention._number(1 << 16) == attention.np.int32


def test_gradients_follow_the_loss():
    """The slopes of all trained arrays, against differences of the loss."""
    np = attention.np
    rng = np.random.default_rng(5)
    s, c, w = attention.SLOTS, attention.CLASSES, attention.WIDTH
    small = lambda *shape: rng.standard_normal(shape) * 0.5
    model = attention.Model(
        slot=None, kind=None, log_slot=None, log_id=None, direct=small(s, c), near=small(attention.WINDOW),
        query=small(s, w), key=small(s, w), value=small(s, w), out=small(w, c),
    )
    slots = rng.integers(0, 9, (attention.SCORED + 3, attention.WINDOW))
    targets, counted = rng.integers(0, c, slots.shape), rng.random(slots.shape) < 0.7

    def loss():
        logits = attention.attend(model, slots, 0)[3].astype(np.float64)
        log = np.take_along_axis(logits, targets[:, :, None], 2)[:, :, 0] - np.log(np.exp(logits).sum(axis=2))
        return -(log * counted).sum() / counted.sum()

    slopes = attention.gradients(model, slots, targets, counted)
    for name in attention.Model.TRAINED:
        place = np.unravel_index(np.abs(slopes[name]).argmax(), slopes[name].shape)
        array, ends = getattr(model, name), []
        for step in (1e-3, -2e-3):
            array[place] += step
            ends.append(loss())
        array[place] += 1e-3
        assert math.isclose((ends[0] - ends[1]) / 2e-3, slopes[name][place], rel_tol=2e-2), name
