"""Sharding, licence scan and preference formatting against brute force."""

import hashlib
import random
import re
import zlib

import pytest

from pagetrail.llm import licences, preferences, sharding


def brute_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, filled = (low + high) // 2, 1, 0
        for s in sizes:
            if filled + s > middle:
                used, filled = used + 1, 0
            filled += s
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("stretches,shards", [(20_000, 16), (7, 5), (3, 1)])
def test_shards_are_minimax(spark, monkeypatch, stretches, shards):
    monkeypatch.setattr(sharding, "STRETCHES", stretches)
    rng = random.Random(2)
    texts = ["é" * rng.randint(0, 300) for _ in range(60)] + ["copy"] * 200 + ["long " * 500, None, None, "", "x"]
    rows = [(i if i % 50 else None, t, 1, "k") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n int, digest string")
    got = sharding.shard(docs, shards).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert set(by) <= set(range(shards))
    for rows_ in by.values():
        assert sorted(r.slot for r in rows_) == list(range(len(rows_)))
    want = {}
    for t in texts:
        key = hashlib.sha256(t.encode()).hexdigest() if t is not None else "g"
        want[key] = want.get(key, 0) + len((t or "").encode()) + 1
    sizes = [want[k] for k in sorted(want)]
    assert max(sum(r["size"] for r in rows_) for rows_ in by.values()) == brute_capacity(sizes, shards)
    known = {r.doc_id: r for r in got if r.doc_id is not None}
    for i, t, *_ in rows:
        if i is not None:
            assert (known[i]["size"], known[i].text_crc32) == (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
    assert len({known[i].shard for i, t, *_ in rows if t == "copy" and i is not None}) == 1


def test_sharding_an_empty_table(spark):
    assert sharding.shard(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_licences_within_longer_documents(spark):
    rng = random.Random(7)
    prose = lambda n: " ".join(f"word{rng.randrange(10**5)}" for _ in range(n))
    mit = licences.TEMPLATES["MIT"][2]
    three = mit.replace(" The above", "\n\nThe above").replace(" THE SOFTWARE IS", "\n\nTHE SOFTWARE IS")
    rows = [
        (1, prose(400) + "\n\n" + three + "\n\n" + prose(900)),
        (2, prose(30) + ". Licensed under the Apache License, Version 2.0. " + prose(40)),
        (3, prose(50) + "\nReleased under the MIT License.\n" + prose(50)),
        (4, prose(100) + " permission is granted " + prose(100)), (5, "permission"),
    ]
    got = {(r.doc_id, r.unit, r.licence) for r in licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {(1, "passage", "MIT"), (2, "passage", "Apache-2.0"), (3, "line", "MIT")}


def brute_licences(rows, threshold):
    out = set()
    known = [(n, set(licences.bigrams(t))) for n, ts in sorted(licences.TEMPLATES.items()) for t in ts]
    for doc, text in rows:
        if text is None:
            continue
        paragraphs = re.split(r"(?:\r\n|\r|\n)[ \t]*(?:\r\n|\r|\n)\s*", text)
        units = [("line", i, x) for i, x in enumerate(re.split(r"\r\n|\r|\n", text), 1)]
        units += [("paragraph", i, x) for i, x in enumerate(paragraphs, 1) if "\n" in x or "\r" in x]
        units += [("text", 1, text)] if len(paragraphs) > 1 else []
        for unit, no, part in units:
            own, best = set(licences.bigrams(part)), (-1.0, "")
            for name, b in known:
                if own and 2 * len(own & b) / (len(own) + len(b)) > best[0]:
                    best = (2 * len(own & b) / (len(own) + len(b)), name)
            if best[0] >= threshold:
                out.add((doc, unit, no, best[1], round(best[0], 9)))
    return out


def test_licence_scan_matches_brute_force(spark):
    rng = random.Random(4)
    mit = licences.TEMPLATES["MIT"][2]
    wrapped = "\n".join(mit[i : i + 70] for i in range(0, len(mit), 70))
    rows = [
        (1, "Some text.\nReleased under the MIT License."),
        (2, "LICENSED under the apache license -- version 2.0\nmore"),
        (3, wrapped),
        (4, "Heading\n\n" + wrapped + "\n\nOther words here."),
        (5, mit.replace("Software", "Library")),
        (6, None), (7, ""), (8, "\n\n\n"), (9, "the license"), (9, "Licensed under CC BY-NC 4.0."),
        (None, "Licensed under CC BY 4.0."),
        (10, " ".join(rng.choices(mit.split(), k=5000))),
        (11, "the software is provided " * 3000),
        (12, "Licensed under the Apache License, Version 3.7 or other terms, by agreement, in writing."),
    ]
    docs = spark.createDataFrame([(*r, "a", 2) for r in rows], "doc_id bigint, text string, own string, unit int")
    got = licences.scan(docs).collect()
    assert {(r.doc_id, r.unit, r.unit_no, r.licence, round(r.dice, 9)) for r in got} == brute_licences(rows, 0.8)
    assert {(r.doc_id, r.licence) for r in got} >= {(1, "MIT"), (2, "Apache-2.0"), (3, "MIT"), (4, "MIT"), (5, "MIT"), (9, "CC-BY-NC-4.0"), (None, "CC-BY-4.0")}
    assert licences.scan(docs.limit(0)).count() == 0


def test_preferences(spark):
    turns = [
        (1, 0, "user", "Hi"), (1, 1, "assistant", "Hello"), (1, 2, "user", "Go on"), (1, 3, "assistant", "Good"),
        (2, 0, "user", "Hi"), (2, 1, "assistant", "Hello"), (2, 2, "user", "Go on"), (2, 3, "assistant", "B<|im_end|>ad"), (2, 4, "user", None),
        (3, 0, "user", "Hi"), (3, 1, None, "x"), (4, 0, "user", "Hi"), (4, 1, None, "x"), (5, 5, "user", ""), (None, 0, "user", "lost"),
        (6, 0, "user", "a"), (6, 0, "assistant", "b"),
    ]
    conversations = spark.createDataFrame([(*t, 9, "z") for t in turns], "conv_id bigint, turn bigint, role string, text string, a int, common string")
    pairs = spark.createDataFrame([(10, 1, 2), (11, 3, 4), (12, 1, None), (13, 5, 77), (14, 6, 5)], "pair_id bigint, chosen bigint, rejected bigint")
    got = {r.pair_id: r for r in preferences.format_pairs(conversations, pairs).collect()}
    turn = lambda role, text: f"<|im_start|>{role}\n{text}<|im_end|>\n"
    r = got[10]
    assert r.prompt == turn("user", "Hi") + turn("assistant", "Hello") + turn("user", "Go on") and r.prompt_turns == 3
    assert r.chosen == turn("assistant", "Good")
    assert [r.chosen[s.start : s.stop] for s in r.chosen_mask] == ["Good<|im_end|>"]
    assert r.rejected == turn("assistant", "B<​|im_end|>ad") + turn("user", "")
    assert [r.rejected[s.start : s.stop] for s in r.rejected_mask] == ["B<​|im_end|>ad<|im_end|>"]
    assert (got[11].prompt_turns, got[11].chosen, got[11].rejected) == (2, "", "")
    assert got[11].prompt == turn("user", "Hi") + turn("user", "x")
    assert (got[12].prompt, got[12].prompt_turns, got[12].rejected) == ("", 0, "") and got[12].chosen.startswith(turn("user", "Hi"))
    assert (got[13].chosen, got[13].rejected, got[13].chosen_mask) == (turn("user", ""), "", [])
    assert got[14].chosen == turn("assistant", "b") + turn("user", "a")


def test_preferences_over_the_next_answer(spark):
    turns = [
        (3, 0, "user", "Q3"), (3, 1, "assistant", "A3"), (3, 2, "user", "thanks"),
        (7, 0, "user", "Q7"), (7, 1, "assistant", "first"), (7, 2, "user", "more"), (7, 3, "assistant", None),
        (8, 0, "user", "nobody answers"), (9, 0, "assistant", "A9"), (12, 0, None, "Q"), (12, 1, "assistant", "A3"), (None, 0, "assistant", "lost"),
    ] + [(20 + i, j, ("user", "assistant")[j % 2], f"{i}.{j}") for i in range(60) for j in range(4)] + [(100, j, ("user", "assistant")[j % 2], "long " * 50) for j in range(2000)]
    rng = random.Random(4)
    rng.shuffle(turns)
    conversations = spark.createDataFrame([(*t, 9, "z") for t in turns], "conv_id bigint, turn bigint, role string, text string, part int, reply string")
    got = {r.pair_id: r for r in preferences.format_answers(conversations).collect()}
    turn = lambda t: f"<|im_start|>{t[2] or 'user'}\n{t[3] or ''}<|im_end|>\n"
    by = {c: sorted(t for t in turns if t[0] == c) for c in {t[0] for t in turns} - {None}}
    last = {c: max((i for i, t in enumerate(ts) if t[2] == "assistant"), default=None) for c, ts in by.items()}
    answered = sorted(c for c in by if last[c] is not None)
    assert set(got) == set(by)
    for c, ts in by.items():
        if last[c] is None:
            other = []
        else:
            following = answered[(answered.index(c) + 1) % len(answered)]
            other = [*ts[: last[c]], (*ts[last[c]][:3], by[following][last[following]][3]), *ts[last[c] + 1 :]]
        n = 0
        while n < min(len(ts), len(other)) and ts[n][2:] == other[n][2:]:
            n += 1
        r = got[c]
        assert (r.prompt, r.prompt_turns) == ("".join(map(turn, ts[:n])), n)
        assert (r.chosen, r.rejected) == ("".join(map(turn, ts[n:])), "".join(map(turn, other[n:])))
        assert [r.rejected[s.start : s.stop] for s in r.rejected_mask] == [f"{t[3] or ''}<|im_end|>" for t in other[n:] if t[2] == "assistant"]
    assert preferences.format_answers(conversations.limit(0)).count() == 0
