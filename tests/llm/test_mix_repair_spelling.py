"""Source mixing, conversation repair and spelling variants against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import product

import pytest

from rfsight.llm import conversations, mixing, spelling

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _counted(rows):
    return Counter(tuple(r) for r in rows)


# ---- mixing -----------------------------------------------------------------------------------


def _mixed(rows):
    """Whole mix by the definition: level by bisection over fractions, keys sorted in one list per source."""
    size = [len(_WORD.findall(t or "")) for _, t, _ in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total = {s: sum(n for n, (*_, x) in zip(size, rows, strict=True) if x == s) for s in names}
    goal, open_ = Fraction(3 * sum(size), 2), set(names)
    target = {s: Fraction(0) for s in names}
    while open_:
        left = goal - sum(2 * total[s] for s in names if s not in open_)
        target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if target[s] >= 2 * total[s]}
        target |= {s: Fraction(2 * total[s]) for s in above}
        if not above:
            break
        open_ -= above
    out = []
    for s in names:
        keyed = []
        for n, (d, t, x) in zip(size, rows, strict=True):
            if x == s:
                words, digest = _WORD.findall(t or ""), hashlib.md5((t or "").encode()).hexdigest()
                u = int(hashlib.md5(f"{'' if d is None else d}:{digest}".encode()).hexdigest()[:12], 16)
                quality = max(0.25, len(set(words)) / n) if n else 1.0
                keyed.append((-math.log((u + 0.5) / 2**48) / quality, -1 if d is None else d, digest, d, n))
        budget = math.floor(target[s] + Fraction(1, 2))
        epochs, rest = divmod(budget, total[s]) if total[s] else (0, 0)
        for *_, d, n in sorted(keyed, key=lambda k: k[:3]):
            part = max(0, min(n, rest))
            rest -= part
            out.append((d, n, total[s], round(float(target[s]), 6), epochs * n + part))
    return out


@pytest.fixture(scope="module")
def sources():
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choices("ab cd ef gh über ij kl mn".split(), k=n))
    rows = [(k, text(rng.randint(0, 30)), rng.choice(["hot"] * 6 + ["b", "Z", "é", "", "c", None])) for k in range(400)]
    rows += [(500 + k, None, "b") for k in range(3)] + [(600, "", "nothing here"), (601, text(4000), "c"), (None, text(9), "b"), (None, text(7), None)]
    return rows + [rows[5]] * 37 + [(700, "same words", "hot")] * 50


@pytest.mark.parametrize("copies", [10_000, 7])
def test_mix(spark, sources, monkeypatch, copies):
    monkeypatch.setattr(mixing, "COPIES", copies)
    docs = spark.createDataFrame([(*r, "x", "y") for r in sources], "doc_id long, text string, source string, quality string, bucket string")
    found = mixing.mix(docs.repartition(5)).collect()
    shown = [(r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in found]
    assert _counted(shown) == _counted(_mixed(sources))
    by = defaultdict(int)
    for r in found:
        by[r["source"], r["target"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    assert all(abs(t - n) <= 0.5 for (_, t), n in by.items())


def test_mix_follows_quality(spark):
    """Of documents of one size, those of higher quality are drawn more often; sources without words take nothing."""
    rows = [(k, f"w{k} x{k}", "a", 4.0 if k % 2 else 1.0) for k in range(600)] + [(9000 + k, "filler " * 3, "b", 1.0) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, q double")
    found = mixing.mix(docs, quality=docs["q"], weights=(1, 9), share=0.5).collect()
    drawn = Counter(r["doc_id"] % 2 for r in found if r["source"] == "a" and r["taken"])
    assert drawn[1] > 1.5 * drawn[0]
    empty = mixing.mix(docs.filter("false"))
    assert empty.count() == 0
    bare = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mixing.mix(bare).collect()] == [(0.0, 0), (0.0, 0)]


# ---- conversations ----------------------------------------------------------------------------


def _damaged(rows):
    out = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(c, t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def _plain(rows):
    """(cost, audit, repaired rows) by a table over rows and states, one conversation."""
    best = {(0, 0): (0, "", [])}
    steps = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
    say = {"u": "user", "a": "assistant"}
    for i in range(len(rows) + 1):
        for _ in range(4):  # inserts lead around within a place
            for s in range(4):
                if (i, s) in best:
                    cost, audit, done = best[i, s]
                    for c, to in steps[s].items():
                        if c != "s":
                            label = (cost + 2, audit + "I", [*done, f"{say[c]}:"])
                            best[i, to] = min(best.get((i, to), label), label, key=lambda x: x[:2])
        if i == len(rows):
            break
        role, text, must_go, cut = rows[i]
        for s in range(4):
            if (i, s) not in best:
                continue
            cost, audit, done = best[i, s]
            ways = [(s, (cost + 3, audit + "D", done))]
            if not must_go:
                c = role[:1]
                if c == "" or c in steps[s]:
                    ways.append((steps[s][c] if c else s, (cost + cut, audit + "K", [*done, f"{role}:{text}"])))
                ways += [(to, (cost + 2 + cut, audit + "R", [*done, f"{say[c]}:{text}"])) for c, to in steps[s].items() if c != "s"]
            for to, label in ways:
                best[i + 1, to] = min(best.get((i + 1, to), label), label, key=lambda x: x[:2])
    return min((best[len(rows), s] for s in (0, 3) if (len(rows), s) in best), key=lambda x: x[:2])


def _repaired(rows):
    """Expected rows of op12 for undamaged rows."""
    after = defaultdict(list)
    for c, t, role, text in _damaged(rows):
        after[c].append((t, role, text))
    out = []
    for c in {r[0] for r in rows}:
        own = sorted(after[c], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        turns = {t for t, *_ in own if t is not None}
        counts, seen, lattice = Counter(), set(), []
        for _, role, text in own:
            fault = None
            if not _WORD.search(text):
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif not re.search(r"[.!?][\x20\x09-\x0D]*\Z", text):
                fault = "truncated"
            seen.add((role, text))
            counts[fault] += 1
            lattice.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:], strict=False)]
        cost, audit, done = _plain(lattice)
        out.append(
            (c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"],
             sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(done).encode()).hexdigest())
        )
    return out


def test_cheapest_edits_over_all_short_conversations():
    kinds = [("s", False, False), ("u", False, True), ("a", False, False), ("u", True, False), ("", False, False), ("x", False, True)]
    for n in range(4):
        for rows in product(kinds, repeat=n):
            wanted = _plain([(c, "t", must, cut) for c, must, cut in rows])
            assert conversations.cheapest(list(rows), 0, (0, 3)) == wanted[:2], rows


def test_blocks_do_not_change_the_repair():
    rng = random.Random(8)
    for n in (0, 1, 5, 17, 60):
        rows = [(rng.choice(["user", "assistant", "system", "tool", ""]), f"t{k}.", rng.random() < 0.2, rng.random() < 0.3) for k in range(n)]
        cost, audit, done = _plain(rows)
        for block in (1, 2, 7, 64):
            ways = conversations.Ways()
            for k in range(0, n, block):
                ways.take(rows[k : k + block], last=False)
            ways.take([], last=True)
            assert ways.end() == (cost, audit, hashlib.sha256("\n".join(done).encode()).hexdigest())


def test_repair(spark):
    rng = random.Random(5)
    texts = ["Yes.", "No", "  ", "", None, "What is it?\n", "Go on", "It is so!", "über."]
    rows = []
    for c in [*range(150), None]:
        for t in range(rng.randint(1, 9)):
            turn = rng.choice([t, t, t, t + 1, t - 1, None])
            rows.append((c, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice(texts)))
    rows += [(900, t, "user" if t % 2 else "assistant", f"{t} of many.") for t in range(300)] + [(901, 3, "user", "again.")] * 40
    rows += [(902, -5, "user", "a."), (902, 90, "assistant", "b.")]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, text string, key string, present string")
    found = conversations.repair(conversations.damaged(table)).collect()
    assert _counted(found) == _counted(_repaired(rows))
    assert conversations.repair(conversations.damaged(table.filter("false"))).count() == 0


def test_nothing_left_after_damage(spark):
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(gone, 0, "user", "Hello.")], "conv_id long, turn long, role string, text string")
    found = conversations.repair(conversations.damaged(table)).collect()
    assert [tuple(r) for r in found] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# ---- spelling ---------------------------------------------------------------------------------


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def _variants(rows):
    count = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = _lower(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            count[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    n = {w: k for w, k in count.items() if len(w) >= 6 and k >= 5}
    near = {w: [o for o in n if _one_edit(w, o)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


@pytest.fixture(scope="module")
def misspelt():
    rng = random.Random(2)
    letters = "aabcdeeéÉßÿ÷no"
    stems = ["".join(rng.choices(letters, k=rng.randint(6, 9))) for _ in range(60)] + ["banana" * 2, "aaaaaaa", "aaaaaaaa", "abababab", "Über" * 3]
    words = []
    for stem in stems:
        words += [stem] * rng.choice([5, 30, 160, 900])
        for _ in range(6):
            k = rng.randrange(len(stem))
            other = rng.choice([stem[:k] + stem[k + 1 :], stem[:k] + rng.choice(letters) + stem[k:], stem[:k] + rng.choice(letters) + stem[k + 1 :]])
            words += [other] * rng.choice([1, 5, 6, 32])
    words += ["chainlink"] * 400 + ["chainlinks"] * 50 + ["chainlinkss"] * 7
    rng.shuffle(words)
    rows = [(k, rng.choice([" ", "-", "3", "\n"]).join(words[50 * k : 50 * k + 50])) for k in range(len(words) // 50)]
    return [*rows, (None, "Banana " * 9), (7, None), (8, ""), rows[0], rows[0], (9, "z" * 3000 + " " + "K" * 3)] + [(10 + k, "é" * 900) for k in range(5)]


def test_spelling_variants(spark, misspelt):
    docs = spark.createDataFrame([(*r, "x", "y") for r in misspelt], "doc_id long, text string, word string, n string").repartition(4)
    found = spelling.variants(docs)
    assert _counted(found.select("word", "form", "root", "n", "n_near", "form_n").collect()) == _counted(_variants(misspelt))
    assert any(r["root"] != (r["form"] or r["word"]) for r in found.collect())
    assert spelling.variants(docs.filter("false")).count() == 0


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(6)
    for _ in range(300):
        word = "".join(rng.choices("abcd", k=rng.randint(6, 14)))
        often = {a + b: rng.randint(1, 9) for a in "abcd" for b in "abcd"}
        prefix = spelling.prefix_grams(word, often)
        (a, i), (b, j) = spelling.pivots(prefix, often)
        assert abs(i - j) >= 2 and {(a, i), (b, j)} <= set(prefix)
        assert often[a] + often[b] == min(often[x] + often[y] for x, i in prefix for y, j in prefix if j >= i + 2)


def test_near_words_share_a_pivot_key():
    rng = random.Random(9)
    often = {a + b: rng.randint(1, 5) for a in "abc" for b in "abc"}
    for _ in range(2000):
        word = "".join(rng.choices("abc", k=rng.randint(6, 9)))
        k = rng.randrange(len(word) + 1)
        other = word[:k] + rng.choice(["", "a", "b", "c"]) + word[k + rng.randint(0, 1) :]
        if _one_edit(word, other) and len(other) >= 6:
            sides = [(spelling.prefix_grams(w, often), w) for w in (word, other)]
            all_keys = [{key for key, _ in spelling.keys(w, p)} for p, w in sides]
            own_keys = [{key for key, g in spelling.keys(w, p) if g in spelling.pivots(p, often)} for p, w in sides]
            assert own_keys[0] & all_keys[1] or own_keys[1] & all_keys[0]
