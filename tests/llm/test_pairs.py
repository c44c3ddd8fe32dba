"""Operators on pairs of documents against brute force: Jaccard join, substring dedup, decontamination."""

import random
import re

import numpy as np
import pytest

from pagetrail.llm import components, decontaminate, jaccard_join, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall((text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).decode())


def table(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id bigint, text string, h string, n int, component string")


def corpus(seed=3, groups=12, copies=9, size=60):
    """Groups of near copies with one to many changed words, exact copies and short texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(groups):
        base = rng.choices(vocabulary, k=rng.randint(3, size))
        for c in range(copies):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append(" ".join(text).upper() if c == 1 else " ".join(text))
    rows += [None, "", "  \n", "one", "one", "One two", "one two", "same same same same same"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def brute_components(rows, k, percent):
    sets = {}
    for doc, text in rows:
        w = words_of(text)
        sets[doc] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("long_list,block,percent", [(64, 2048, 90), (2, 4, 80)])
def test_jaccard_classes_match_brute_force(spark, monkeypatch, long_list, block, percent):
    monkeypatch.setattr(jaccard_join, "LIST", long_list)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_classes(table(spark, rows), 3, percent).collect()}
    assert got == brute_components(rows, 3, percent)


@pytest.mark.parametrize("long_list,block", [(64, 256), (2, 4)])
def test_jaccard_links_match_brute_force(spark, monkeypatch, long_list, block):
    monkeypatch.setattr(jaccard_join, "LIST", long_list)
    monkeypatch.setattr(jaccard_join, "COUNT_BLOCK", block)
    rows = corpus()
    rng = random.Random(4)
    base = [f"b{i}" for i in range(200)]
    for d in range(100):  # near copies with pairwise different texts
        text = list(base)
        text[rng.randrange(200)] = f"d{d}"
        rows.append((1000 + d, " ".join(text)))
    sets = {}
    for doc, text in rows:
        w = words_of(text)
        sets[doc] = frozenset(tuple(w[i : i + 3]) for i in range(len(w) - 2)) if len(w) >= 3 else frozenset([tuple(w)] if w else [])
    classes = {s for s in sets.values() if s}
    near = lambda r, s: r & s and 100 * len(r & s) >= 90 * len(r | s)
    degree = {r: sum(bool(near(r, s)) for s in classes if s != r) for r in classes}
    got = {r.doc_id: r.n_links for r in jaccard_join.jaccard_classes(table(spark, rows), 3, 90).collect()}
    assert got == {d: degree.get(s, 0) for d, s in sets.items()}
    assert got[1000] == 99


def test_jaccard_classes_of_odd_tables(spark):
    assert jaccard_join.jaccard_classes(table(spark, [])).count() == 0
    rows = [(7, "a b c d"), (7, "a b c d"), (None, "a b c d"), (9, "A B c d"), (8, None)]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_classes(table(spark, rows)).collect())
    assert got == [(False, 7, 2, 7), (False, 7, 2, 7), (False, 8, 0, 8), (False, 9, 2, 7), (True, 0, 2, None)]


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 51), (51, 51), (None, 3)], "a bigint, b bigint")
    got = {r.node: r.component for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 51: 50}


def passage_corpus(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(900)]
    text = lambda n: rng.choices(vocabulary, k=n)
    exact, fuzzy, short = text(70), text(80), text(30)
    rows, planted = [], {}
    for d in range(30):
        body = text(rng.randint(40, 300))
        cut = rng.randint(0, len(body))
        if d in (2, 9, 17):
            planted[d] = (cut, cut + 70)
            body[cut:cut] = exact
        elif d in (4, 21):
            edited = [rng.choice(vocabulary) if d == 21 and i % 16 == 8 else w for i, w in enumerate(fuzzy)]
            planted[d] = (cut, cut + 80)
            body[cut:cut] = edited
        elif d in (5, 6, 7, 8):
            body[cut:cut] = short
        rows.append((d, " ".join(body)))
    return rows, planted


def test_passages_are_found_and_cut(spark):
    rows, planted = passage_corpus()
    rows += [(40, None), (41, ""), (None, rows[2][1]), (42, "again and again " * 200), (43, "again and again " * 200)]
    docs = table(spark, rows)
    found = substring_dedup.passages(docs)
    got = {(r.doc_id, r.first_doc_id): (r.start_word, r.end_word) for r in found.collect()}
    assert set(got) == {(9, 2), (17, 2), (21, 4), (43, 42)}
    for (doc, _), (start, end) in got.items():
        if doc in planted:
            assert abs(start - planted[doc][0]) <= 6 and abs(end - planted[doc][1]) <= 6
    kept = substring_dedup.without_passages(docs, found)
    assert kept.columns == docs.columns
    left = {r.doc_id: r.text for r in kept.collect()}
    assert 43 not in left and set(left) == {d for d, _ in rows} - {43}
    for doc, text in rows:
        if doc in (9, 17):
            w = words_of(text)
            assert words_of(left[doc]) == w[: planted[doc][0]] + w[planted[doc][1] :]
        elif doc not in (21, 43, None):
            assert left[doc] == text
    assert substring_dedup.passages(table(spark, [])).count() == 0


def test_passages_of_lines_that_earlier_documents_hold_singly(spark):
    rng = random.Random(8)
    text = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    lines = [text(15) for _ in range(6)]
    rows = [(i, " ".join(text(40) + line + text(40))) for i, line in enumerate(lines)]
    passage = [w for line in lines for w in line]
    rows += [(50, " ".join(text(30) + passage + text(60))), (90, " ".join(text(70) + passage + text(20)))]
    got = {(r.start_word, r.end_word) for r in substring_dedup.passages(table(spark, rows)).collect() if (r.doc_id, r.first_doc_id) == (90, 50)}
    assert (70, 160) in got


def test_passages_whose_seeds_are_first_held_by_different_documents(spark):
    rng = random.Random(14)
    text = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    # no document but 900 and 901 holds 50 of the words; each run of 16 or fewer is held by earlier ones
    for step, edit in ((10, 0), (2, 0), (10, 12)):
        passage = text(120)
        rows = [(i, " ".join(text(30) + passage[at : at + 40] + text(30))) for i, at in enumerate(range(-30, 120, step)) if passage[max(at, 0) : at + 40]]
        edited = [text(1)[0] if edit and i % edit == edit - 1 else w for i, w in enumerate(passage)]
        rows += [(900, " ".join(text(70) + passage + text(60))), (901, " ".join(text(80) + edited + text(70)))]
        found = substring_dedup.passages(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
        assert {(r.start_word, r.end_word, r.first_start_word, r.first_end_word) for r in found if (r.doc_id, r.first_doc_id) == (901, 900)} == {(80, 200 - bool(edit), 70, 190 - bool(edit))}


def test_all_holders_of_a_seed_are_linked(monkeypatch):
    rng = np.random.default_rng(15)
    for holders, chunk in ((8, 2_000_000), (3, 50), (1, 7)):
        monkeypatch.setattr(substring_dedup, "HOLDERS", holders)
        monkeypatch.setattr(substring_dedup, "CHUNK", chunk)
        rows = sorted({(int(h), int(d), int(p)) for h, d, p in zip(rng.integers(1, 60, 300), rng.integers(0, 12, 300), rng.integers(0, 40, 300), strict=True)})
        want, by_seed = set(), {}
        for h, d, p in rows:
            by_seed.setdefault(h, {}).setdefault(d, []).append(p)
        for docs in by_seed.values():
            ids = sorted(docs)
            for i, d in enumerate(ids):
                for hub in ids[:i] if len(ids) <= holders else ids[: min(i, 1)]:
                    want |= {(d, hub, x, min(docs[hub])) for x in docs[d]}
        got = set()
        parts = []
        for third in range(3):  # three chunks of documents
            own = [r for r in rows if r[1] % 3 == third]
            rng.shuffle(own)
            h, d, p = (np.array(c) for c in zip(*own, strict=True))
            sent, anchors = substring_dedup._packed_seeds(h.astype(np.uint64) << np.uint64(8), d, p)
            parts.append(sent)
            chunk_links = set(zip(*(c.tolist() for c in anchors[:4]), strict=True))
            assert all(a[1] < a[0] for a in chunk_links)
            got |= chunk_links
        for anchors in substring_dedup._linked(*(np.concatenate(c) for c in zip(*parts, strict=True))):
            got |= set(zip(*(c.tolist() for c in anchors[:4]), strict=True))
        crowded = {h for h, docs in by_seed.items() if len(docs) > holders}
        assert want <= got or crowded  # links of a crowded seed may go by its chunk's first holder
        linked = {(d, hub) for d, hub, _, _ in got}
        for h, docs in by_seed.items():
            ids = sorted(docs)
            if h not in crowded:
                assert {(d, hub) for i, d in enumerate(ids) for hub in ids[:i]} <= linked
            else:
                assert all(any((d, hub) in linked for hub in ids[:i]) for i, d in enumerate(ids) if i)


def test_passages_repeated_in_one_document(spark):
    rng = random.Random(9)
    text = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    passage = text(60)
    rows = [(5, " ".join(text(30) + passage + text(30))), (9, " ".join(text(20) + passage + text(100) + passage + text(20)))]
    got = {(r.start_word, r.end_word) for r in substring_dedup.passages(table(spark, rows)).collect()}
    assert got == {(20, 80), (180, 240)}


def test_repeated_ids_keep_their_other_texts(spark):
    rng = random.Random(11)
    text = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    passage = text(70)
    rows = [(1, passage), (7, passage + " " + text(9)), (7, text(200)), (7, "short"), (8, passage), (8, passage)]
    docs = table(spark, rows)
    kept = substring_dedup.without_passages(docs, substring_dedup.passages(docs)).collect()
    left = sorted((r.doc_id, r.text) for r in kept if r.doc_id == 7)
    whole = sorted((d, t) for d, t in rows if d == 7 and not t.startswith(passage))
    assert [x for x in left if x in whole] == whole and len(left) == 3     # only the text with the passage may be cut
    assert [r.doc_id for r in kept if r.doc_id == 8] == []                 # equal rows are cut alike


def test_chunks_find_what_one_chunk_finds(spark, monkeypatch):
    rng = random.Random(13)
    text = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    shared = [text(60) for _ in range(8)]
    rows = [(i, " ".join(text(30) + shared[i % 8] + text(30))) for i in range(80)]
    for chunk in (2_000_000, 300):
        monkeypatch.setattr(substring_dedup, "CHUNK", chunk)
        found = substring_dedup.passages(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
        assert {r.doc_id for r in found} == set(range(8, 80)) and {(r.start_word, r.end_word) for r in found} == {(30, 90)}
        assert all(r.first_doc_id < r.doc_id and r.distance == 0 for r in found)


def test_passage_survives_a_common_line_after_it(spark):
    rng = random.Random(10)
    text = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    passage, line = text(50), text(16)
    rows = [(d, " ".join(text(40) + line + text(20) + passage + text(20) + line + text(40))) for d in (5, 9)]
    got = {(r.start_word, r.end_word, r.distance) for r in substring_dedup.passages(table(spark, rows)).collect()}
    assert got == {(76, 126, 0)}


def test_steps_are_a_best_alignment():
    rng = np.random.default_rng(2)
    for n in [*range(30), 150, 300]:
        a, b = (rng.integers(0, 4, n + rng.integers(0, 9)).astype(np.uint32) for _ in range(2))
        ops = substring_dedup.steps(a, b)
        assert (ops != substring_dedup.ONLY_B).sum() == len(a) and (ops != substring_dedup.ONLY_A).sum() == len(b)
        assert (ops != substring_dedup.MATCH).sum() == edits(a.tolist(), b.tolist())


def test_recall_of_fuzzy_passages(spark):
    rng = random.Random(12)
    text = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    rows, cases = [], [(60, 8), (60, 7), (60, 6), (120, 6), (61, 5), (60, 0)]
    for case, (size, every) in enumerate(cases):
        for n in range(60):
            passage = text(size)
            changed = set(range(every - 1, size, every)) if every else set(rng.sample(range(1, size - 1), size // 6))
            edited = [text(1)[0] if i in changed else w for i, w in enumerate(passage)]
            d = 1000 * case + 2 * n
            rows += [(d, " ".join(text(80) + passage + text(80))), (d + 1, " ".join(text(60) + edited + text(90)))]
    got = {}
    for r in substring_dedup.passages(table(spark, rows)).collect():
        assert r.first_doc_id == r.doc_id - 1 and r.similarity >= 0.8
        got.setdefault(r.doc_id // 1000, set()).add(r.doc_id)
    recall = {case: len(got.get(i, ())) / 60 for i, case in enumerate(cases)}
    print("recall", recall)
    assert min(recall.values()) >= 0.95, recall


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_distance_is_the_edit_distance():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = (rng.integers(0, 4, rng.integers(0, 30)).astype(np.uint32) for _ in range(2))
        assert substring_dedup.distance(a, b) == edits(a.tolist(), b.tolist())


def test_chains_join_ordered_matches_and_split_at_gaps():
    x = np.r_[np.arange(0, 60, 3), np.arange(400, 460, 3), 30]
    y = np.r_[np.arange(100, 160, 3), np.arange(505, 565, 3), 900]
    found = sorted(substring_dedup.chains(x, y))
    assert (0, 62, 100, 162, 20) in found and (400, 462, 505, 567, 20) in found


def substring_edits(item, text):
    """Least edits of the item against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def leak_corpus(seed=11):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([15, 25, 40])))) for i in range(20)] + [(90, None), (91, ""), (92, "alpha beta gamma")]
    rows = []
    for d in range(120):
        body = rng.choices(vocabulary, k=rng.randint(20, 200))
        if d % 2:
            part = items[d % 20][1].split()
            for _ in range(rng.randint(0, len(part) // 5)):
                kind, at = rng.randrange(3), rng.randrange(len(part))
                part[at : at + (kind != 1)] = [] if kind == 2 else [rng.choice(vocabulary)]
            body[len(body) // 2 : len(body) // 2] = part
        rows.append((d, " ".join(body)))
    return rows + [(200, None), (201, ""), (None, items[0][1]), (203, "so Alpha, beta gamma!")], items


def test_leaks_match_brute_force(spark):
    rows, items = leak_corpus()
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in decontaminate.leaks(table(spark, rows), benchmark).collect()}
    want = {}
    for doc, text in rows:
        w = [x.lower() for x in re.findall(r"[^\W_]+", text or "")]
        for item, passage in items:
            p = [x.lower() for x in re.findall(r"[^\W_]+", passage or "")]
            if p and w and (e := substring_edits(p, w)) <= int(0.2 * len(p) + 1e-9):
                want[doc, item] = e
    assert set(got) <= set(want)
    assert len(got) >= 0.95 * len(want)  # recall of the sampled tables
    assert all(got[k] == want[k] for k in got)
    assert (203, 92) in got and (None, 0) in got
    assert decontaminate.leaks(table(spark, []), benchmark).count() == 0
    assert decontaminate.leaks(table(spark, rows), benchmark.limit(0)).count() == 0


def test_short_items_with_one_edited_word(spark):
    rng = random.Random(21)
    words = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    items, rows, want = [], [], {}
    for size in range(5, 13):
        for n in range(40):
            item = words(size)
            items.append((len(items), " ".join(item)))
            at = (0, size // 2, size - 1)[n % 3]
            kind = n % 2  # replaced or left out
            part = item[:at] + words(1 - kind) + item[at + 1 :]
            rows.append((len(rows), " ".join(words(20) + part + words(20))))
            want[len(rows) - 1, len(items) - 1] = (size, at == 0)
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(table(spark, rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert found <= set(want)
    for first in (False, True):
        for size in range(5, 13):
            cases = [k for k, v in want.items() if v == (size, first)]
            assert sum(k in found for k in cases) >= 0.9 * len(cases), (size, first)


def test_dense_never_drops_a_passage():
    """Rows that the density test leaves out have no part of 50 words at 0.8 (brute force over ranges on both sides)."""
    rng = np.random.default_rng(5)
    one, two, kept = [], [], []
    for case in range(60):
        n = int(rng.integers(30, 90))
        a = rng.integers(0, 2**32, n, dtype=np.uint32)
        b = a.copy()
        b[rng.random(n) < rng.choice([0.05, 0.15, 0.2, 0.25, 0.4])] = rng.integers(0, 2**32, dtype=np.uint32)
        b = np.delete(b, rng.integers(0, n, int(rng.integers(0, 4))))
        one.append(a)
        two.append(b)
        kept.append(any(
            substring_dedup.distance(a[i:j], b[u:v]) <= 0.2 * max(j - i, v - u)
            for i in range(0, n - 49, 3) for j in range(i + 50, n + 1, 3)
            for u in range(max(0, i - 4), i + 1) for v in range(max(u + 50, j - 4), min(j, len(b)) + 1)))
    at, bt = (np.cumsum([0, *map(len, x)]) for x in (one, two))
    zero = np.zeros(60, np.int64)
    found = substring_dedup._dense(np.concatenate(one), at, np.concatenate(two), bt, zero, np.diff(at), zero, np.diff(bt), 50, 0.8)
    assert any(kept) and not all(found)
    assert all(f for f, k in zip(found, kept, strict=True) if k)


def test_margin_steps_are_steps():
    """Many margins at once give the alignment of each by itself, forwards and backwards, empty ones included."""
    rng = np.random.default_rng(8)
    one, two = (rng.integers(0, 4, 3000, dtype=np.uint32) for _ in range(2))
    two[500:2500] = one[480:2480]
    a = rng.integers(100, 2800, 700)
    b = np.clip(a + rng.integers(-20, 60, 700), 100, 2800)
    n, m = (rng.integers(0, substring_dedup.MARGIN + 1, 700) for _ in range(2))
    for step in (1, -1):
        got = substring_dedup.margin_steps(one, a, n, two, b, m, step)
        for k in range(700):
            x = one[a[k] + step * np.arange(n[k])]
            y = two[b[k] + step * np.arange(m[k])]
            assert got[k].tolist() == substring_dedup.steps(x, y).tolist()
    assert substring_dedup.margin_steps(one, a[:0], n[:0], two, b[:0], m[:0], 1) == []
