"""Compact windows by definition, planted near-duplicate passages, corner cases."""

import random

import numpy as np

from rowsmith.llm import compact


def test_windows_are_those_of_the_definition():
    rng = np.random.default_rng(3)
    order = rng.permutation(200).astype(np.uint64)
    found = set(compact.windows_of(order, 20))
    for low in range(0, 181, 7):
        for high in range(low + 19, 200, 11):
            at = low + int(order[low : high + 1].argmin())
            # Every stretch lies in exactly one window around its own minimum.
            assert sum(1 for l, c, r in found if l <= low and high <= r and c == at) == 1
    assert all(order[l : r + 1].argmin() + l == c and r - l >= 19 for l, c, r in found)


def test_best_run_is_the_largest_surplus():
    rng = np.random.default_rng(4)
    for _ in range(30):
        hit = rng.random(40) < 0.6
        start, stop = compact.best_run(hit, 0.8)
        gain = lambda a, b: sum(0.2 if h else -0.8 for h in hit[a:b])
        assert abs(gain(start, stop) - max(gain(a, b) for a in range(41) for b in range(a, 41))) < 1e-9


def brute(a, b, least, threshold):
    """Whether two stretches of at least ``least`` shingles have the similarity, by trying all up to 60 long."""
    sa, sb = ([tuple(w[k : k + 5]) for k in range(len(w) - 4)] for w in (a, b))
    for i in range(len(sa) - least + 1):
        for j in range(len(sb) - least + 1):
            for m in range(least, min(61, len(sa) - i + 1)):
                mine = set(sa[i : i + m])
                for n in range(max(least, m - 2), min(m + 3, len(sb) - j + 1)):
                    theirs = set(sb[j : j + n])
                    if len(mine & theirs) >= threshold * len(mine | theirs) - 1e-9:
                        return True
    return False


def test_one_edit_at_every_place_is_verified():
    for n in (50, 60):
        base = np.arange(1000, 1000 + n)
        for junk in (0, 7):
            edge = lambda k: np.arange(k, k + junk)
            a = np.concatenate([edge(10), base, edge(30)])
            for place in range(n):
                changed = np.concatenate([edge(50), base, edge(70)])
                changed[junk + place] = 9
                found = compact.verified(a, changed, 46, 0.8)
                # 41 of 51 shingles are shared where all of them are touched by the word, more where it is at an end.
                assert found and found[0][4] >= 0.8 and found[0][1] - found[0][0] >= 50
    rng = random.Random(9)
    for _ in range(25):
        a = [rng.randrange(10**6) for _ in range(58)]
        b = list(a)
        for _ in range(rng.randrange(1, 4)):
            place = rng.randrange(len(b))
            b[place : place + rng.randrange(2)] = [rng.randrange(10**6) for _ in range(rng.randrange(2))]
        assert bool(compact.verified(np.array(a), np.array(b), 46, 0.8)) == brute(a, b, 46, 0.8)


def test_planted_passages_are_found_and_others_left_alone(spark):
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(4000)]
    made = lambda k: [rng.choice(vocab) for _ in range(k)]
    passages = [made(60), made(80), made(140)]
    rows, planted = [], {}
    for d in range(40):
        text = made(rng.randrange(20, 160))
        if d % 2:
            k = rng.randrange(3)
            passage = list(passages[k])
            if d % 4 == 1:
                passage[len(passage) // 2] = f"x{d}"
            planted[d] = (k, len(text), len(passage))
            text += passage + made(rng.randrange(0, 120))
        rows.append((d, " ".join(text)))
    found = compact.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by_doc = {}
    for r in found:
        assert r.doc_id > r.other_id and r.similarity >= 0.8 and r.end_word - r.start_word >= 50
        for d, start, end in ((r.doc_id, r.start_word, r.end_word), (r.other_id, r.other_start, r.other_end)):
            k, at, n = planted[d]
            # What is reported is the planted passage, give or take a few words at its ends.
            assert at - 15 <= start and end <= at + n + 15
            by_doc.setdefault(d, set()).update(range(start, end))
        assert planted[r.doc_id][0] == planted[r.other_id][0]
    exact = {d for d in planted if d % 4 == 3}
    assert exact <= set(by_doc)
    for d in exact:
        k, at, n = planted[d]
        assert len(by_doc[d] & set(range(at, at + n))) >= 0.8 * n
    # One changed word in sixty is near the threshold; most are met all the same.
    assert len(set(by_doc) & set(planted)) >= 0.8 * len(planted)


def test_passages_made_of_frequent_lines_and_families_are_found(spark):
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(4000)]
    made = lambda k: [rng.choice(vocab) for _ in range(k)]
    rows, want, d = [], set(), 0
    late = []
    for g in range(20):
        # Four lines that each stand in documents of their own, and together in two later ones.
        lines = [made(15) for _ in range(4)]
        for line in lines:
            for _ in range(3):
                rows.append((d, " ".join(made(60) + line + made(60))))
                d += 1
        late += [(1000 + 2 * g + k, " ".join(made(30) + sum(lines, []) + made(30))) for k in (0, 1)]
        want.add((1000 + 2 * g, 1001 + 2 * g))
    for g in range(20):
        # The earliest is like neither of two that are alike.
        base = made(100)
        first = list(base)
        for place in range(4, 100, 12):
            first[place] = "x"
        rows.append((d, " ".join(made(20) + first + made(20))))
        d += 1
        for k in (0, 1):
            variant = list(base)
            variant[30 + 30 * k] = f"y{g}"
            late.append((2000 + 2 * g + k, " ".join(made(20) + variant + made(20))))
        want.add((2000 + 2 * g, 2001 + 2 * g))
    rows += late
    found = compact.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.other_id, r.doc_id) for r in found} >= want
    texts = {d: t.split() for d, t in rows}
    for r in found:
        grams = [{tuple(t[k : k + 5]) for k in range(i, j - 4)} for t, i, j in ((texts[r.doc_id], r.start_word, r.end_word), (texts[r.other_id], r.other_start, r.other_end))]
        assert abs(len(grams[0] & grams[1]) / len(grams[0] | grams[1]) - r.similarity) < 1e-9 and r.similarity >= 0.8


def test_rows_without_an_id_are_documents_of_their_own(spark):
    long = " ".join(f"v{i}" for i in range(60))
    rows = [(None, "x " + long), (None, long + " y"), (7, "other " * 60), (7, "q " + long)]
    found = compact.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.other_id) for r in found} == {(None, None), (7, None)}


def test_corner_cases(spark):
    long = " ".join(f"v{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, "a b c"), (4, long), (4, long), (None, "x " + long.upper() + "."), (5, "r " * 9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "text as w", "2 as l")
    got = [tuple(r) for r in compact.passages(df).collect()]
    assert got == [(4, 0, 60, None, 1, 61, 1.0)]
    assert compact.passages(df.where("doc_id = 99")).count() == 0


def test_runs_are_those_of_the_least_hashes():
    rng = np.random.default_rng(7)
    texts = [rng.integers(-(2**63), 2**63 - 1, n) for n in (60, 46, 130)] + [np.resize(rng.integers(-(2**63), 2**63 - 1, 3), 200), np.zeros(300, np.int64)]
    texts.append(np.concatenate([rng.integers(-(2**63), 2**63 - 1, 20), texts[2][10:90]]))
    edges = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    salt, held = compact.salts(4), {}
    for band, (name, row, c, start, stop, words) in enumerate(compact.name_runs(np.concatenate(texts), edges, 46, 4, 2)):
        for k, t in enumerate(texts):
            own = np.flatnonzero(row == k)
            least = [compact.drawn(t, salt[2 * band + f]) for f in (0, 1)]
            brute = [tuple(int(x[p : p + 46].min()) for x in least) for p in range(len(t) - 45)]
            turns = [p for p in range(len(brute)) if not p or brute[p] != brute[p - 1]]
            assert start[own].tolist() == turns and stop[own].tolist() == [p - 1 for p in turns[1:]] + [len(brute) - 1]
            for q in own:
                assert least[0][c[q]] == brute[start[q]][0] and start[q] <= c[q] < start[q] + 46
                assert held.setdefault((band, int(name[q])), brute[start[q]]) == brute[start[q]]
                stretch = t[start[q] : stop[q] + 46].tobytes()
                assert held.setdefault(int(words[q]), stretch) == stretch
    assert len(compact.windows_of(np.zeros(60_000, np.uint64), 46)) == 59_955


def test_a_pair_that_no_first_run_is_like_is_compared(spark):
    rng = random.Random(21)
    made = lambda k: [f"w{rng.randrange(10**6)}" for _ in range(k)]
    rows, want = [], set()
    for g in range(3):
        passage = made(50)
        for k in range(600):
            # Two changed words: most min-hashes are those of the passage, yet it is not like it.
            other = list(passage)
            for place in (rng.randrange(5, 23), rng.randrange(28, 45)):
                other[place] = made(1)[0]
            rows.append((10_000 * g + 10 * k, " ".join(made(10) + other + made(10))))
        a, b = 10_000 * g + 2001, 10_000 * g + 4003
        rows += [(d, " ".join(made(10) + passage + made(10))) for d in (a, b)]
        want.add((a, b))
    found = compact.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.other_id, r.doc_id) for r in found} >= want


def test_equal_texts_are_linked_to_the_first(spark):
    long = " ".join(f"v{i}" for i in range(80))
    rows = [(d, long) for d in (9, 3, 5)] + [(None, "r " * 200), (4, "r " * 200), (1, "a b " + long)]
    found = [tuple(r) for r in compact.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert {r for r in found if r[0] in (5, 9)} == {(5, 0, 80, 3, 0, 80, 1.0), (9, 0, 80, 3, 0, 80, 1.0)}
    assert {(r[0], r[3]) for r in found} == {(5, 3), (9, 3), (3, 1), (4, None)}


def test_passages_alike_share_a_piece_and_its_seed():
    rng = np.random.default_rng(17)
    piece = compact.unbroken(46, 0.8)
    assert piece == 25
    new = lambda n: rng.integers(-(2**63), 2**63 - 1, n)
    for _ in range(300):
        a = new(int(rng.integers(50, 130)))
        cuts = np.sort(rng.integers(1, len(a), rng.integers(1, 4)))
        # Words changed, put in or left out, or two parts that change places.
        parts = np.split(a, cuts)
        b = np.concatenate([x for p in parts for x in (p[int(rng.integers(2)) :], new(int(rng.integers(2))))]) if rng.random() < 0.7 else np.concatenate(parts[::-1])
        if len(b) < 50 or compact.similarity_of(compact.shingles(a), compact.shingles(b)) < 0.8:
            continue
        texts = [np.concatenate([new(40), x, new(40)]) for x in (a, b)]
        edges = np.array([0, len(texts[0]), len(texts[0]) + len(texts[1])])
        (name, row, *_), = compact.stretch_runs(np.concatenate(texts), edges, 50, piece, 16, 1, 1)
        assert set(name[row == 0]) & set(name[row == 1])


def test_short_loops_do_not_meet_and_long_ones_do():
    words = lambda *parts: np.concatenate([np.full(n, w, np.int64) if n > 0 else np.arange(w, w - n) for w, n in parts])
    texts = [words((100 * k, -40), (7, n), (100 * k + 50, -40)) for k, n in ((1, 34), (2, 40), (3, 60), (4, 9000))]
    # The same loop and what stands behind it, with other words before.
    texts.append(words((500, -40), (7, 30), (150, -40)))
    edges = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    (name, row, c, start, stop, _), = compact.stretch_runs(np.concatenate(texts), edges, 50, 25, 16, 1, 1)
    shared = {(i, j) for i in range(5) for j in range(i) if set(name[row == i]) & set(name[row == j])}
    assert shared == {(3, 2), (4, 0)}


def test_pairs_that_cannot_be_alike_are_told_from_the_others():
    rng = np.random.default_rng(18)
    a, b = [], []
    for k in range(60):
        one = rng.integers(0, 2**31, 60 + k)
        two = one.copy()
        two[rng.integers(0, len(two), k % 7)] = -1
        a.append(one)
        b.append(two if k % 5 else rng.integers(0, 2**31, 40))
    flat = lambda x: (np.concatenate(x), np.concatenate([[0], np.cumsum([len(y) for y in x])]))
    may = compact.may_hold(*flat(a), *flat(b), 46, 0.8)
    assert not may[::5].any()
    for k in range(60):
        assert may[k] or not compact.verified(a[k], b[k], 46, 0.8)


def family(rng, n, edits):
    """Copies of one passage with words changed in places of their own: neighbours of a chain are alike, far ones are not."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    out = []
    for _ in range(n):
        copy = list(base)
        for place in rng.sample(range(120), edits):
            copy[place] = f"x{rng.randrange(10**6)}"
        out.append(copy)
    return out


def flat_runs(texts, seed_at):
    kinds = {}
    words = [np.array([kinds.setdefault(w, len(kinds) + 1) for w in t], np.int32) for t in texts]
    return np.concatenate(words), np.append(0, np.cumsum([len(w) for w in words])), np.array(seed_at)


def test_runs_are_in_as_few_classes_as_all_pairs_make():
    rng = random.Random(31)
    for edits in (2, 4, 6):
        texts = family(rng, 25, edits) + family(rng, 10, 3)
        seed = [f"s{k}" for k in range(16)]
        # One seed in the middle of all: two families that are not alike.
        texts = [t[:52] + seed + t[68:] for t in texts]
        words, edges, at = flat_runs(texts, [52] * len(texts))
        n = len(texts)
        label, who = np.array([0, 0] + list(range(1, n - 1))), np.arange(n)
        pairs, classes = compact.joined(words, edges, at, who, label, 1 + np.arange(n), 46, 0.8)
        want, tried = label.copy(), 0
        for i in range(n):
            for j in range(i):
                if label[i] or label[j]:
                    tried += 1
                    found = compact.verified(words[edges[i] : edges[i + 1]], words[edges[j] : edges[j + 1]], 46, 0.8)
                    if any(s <= 52 <= e - 5 and f <= 52 <= g - 5 for s, e, f, g, _ in found):
                        want[want == max(want[i], want[j])] = min(want[i], want[j])
        assert [[x == y for x in classes] for y in classes] == [[x == y for x in want] for y in want]
        assert len(pairs) == len(set(label)) - len(set(want)) < tried / 5


def test_links_of_a_family_grow_with_its_copies(spark):
    rng, counts = random.Random(33), []
    made = lambda k: [f"v{rng.randrange(10**6)}" for _ in range(k)]
    for n in (30, 120):
        texts = [made(5) + t + made(5) for t in family(rng, n, 5)]
        rows = [(d, " ".join(t)) for d, t in enumerate(texts)]
        found = compact.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        counts.append(len(found))
        # Every document that is like another one is in its class.
        classes = {d: d for d in range(n)}
        top = lambda d: d if classes[d] == d else top(classes[d])
        for r in found:
            classes[top(r.doc_id)] = top(r.other_id)
        words, edges, _ = flat_runs(texts, [0] * n)
        for i in range(n):
            for j in range(i):
                if top(i) != top(j):
                    assert not compact.verified(words[edges[i] : edges[i + 1]], words[edges[j] : edges[j + 1]], 46, 0.8)
    assert counts[1] <= 6 * counts[0]


def test_names_of_many_blocks_make_the_same_classes(spark, monkeypatch):
    rng = random.Random(35)
    rows = [(d, " ".join(t)) for d, t in enumerate(family(rng, 40, 5) + family(rng, 10, 2))]
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def classes():
        tops = {d: d for d, _ in rows}
        for r in compact.passages(df).collect():
            one, two = tops[r.doc_id], tops[r.other_id]
            tops = {d: min(one, two) if t in (one, two) else t for d, t in tops.items()}
        return tops

    whole = classes()
    monkeypatch.setattr(compact, "BLOCK", 7)
    assert classes() == whole
