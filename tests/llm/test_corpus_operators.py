"""Each operator against brute force on small tables with nulls, empty and long texts, ties and repeated rows."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import shutil
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rfsight.llm import (
    contamination,
    licenses,
    ngram_join,
    packing,
    quality,
    sharding,
    spotsigs,
    suffix_dedup,
    token_index,
    warc,
)
from rfsight.llm.arrow import utf8
from rfsight.llm.components import components
from rfsight.llm.encode import Encoder
from rfsight.llm.queries import tokenizer_file
from rfsight.llm.scratch import new_folder

SYLLABLES = "the of re ing er on ti an in ed es ou la que über ñor éa".split()
#: Extra columns whose names the operators use themselves.
CLASHES = ["row", "key", "id_key", "digest", "score", "kept", "spans", "set_id", "group", "shard", "part", "n_words", "marks"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


def _sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n))


def _rows() -> list[tuple[int | None, str | None]]:
    rng = random.Random(7)
    texts: list[str | None] = [None, "", " \n\t ", "one", "Two Words", "a b c d e", "A B c d E", "x" * 5000, "ab" * 900]
    base = [_sentence(rng, 120) for _ in range(6)]
    passage = _sentence(rng, 90)
    for text in base:
        words = text.split()
        texts += [text, text.upper(), " ".join([*words[:60], "changed", *words[61:]]), " ".join(words[:100]), text]
    texts += [f"{_sentence(rng, 30)} {passage} {_sentence(rng, 30)}" for _ in range(5)]
    texts += [f"{passage} {passage}", "\n".join(["the same line of it again and again"] * 40), _sentence(rng, 9000)]
    rows: list[tuple[int | None, str | None]] = [(3 * k - 5, text) for k, text in enumerate(texts)]
    return [*rows, rows[9], rows[9], (None, base[1]), (None, None), (None, "no id and no copy of it anywhere")]


ROWS = _rows()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en", "s", len(t or ""), *["x"] * len(CLASHES)) for d, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _sorted(rows):
    return sorted(rows, key=repr)


# ---- quality ----------------------------------------------------------------------------------


def test_quality_learns_from_one_fold_and_scores_all(spark):
    rng = random.Random(1)
    rows = [(k, _sentence(rng, 60) if k % 2 else " ".join(w.upper() + "!!" for w in _sentence(rng, 60).split())) for k in range(300)]
    docs = spark.createDataFrame([*rows, (300, None), (301, ""), (None, "text")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)] + [(5, None)], "doc_id long, quality int")
    found = quality.classify(docs, labels).collect()
    assert len(found) == 303 and all(0 <= r["score"] <= 1 for r in found)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == (r["score"] >= 0.5)
        if r["doc_id"] is not None and r["doc_id"] < 300:
            assert r["predicted"] == r["doc_id"] % 2


def test_held_out_labels_do_not_matter(spark):
    rng = random.Random(2)
    docs = spark.createDataFrame([(k, _sentence(rng, 40)) for k in range(120)], "doc_id long, text string")
    rows = [(k, k % 2) for k in range(120)]
    turned = [(k, 1 - q if zlib.crc32(str(k).encode()) % 3 == 1 else q) for k, q in rows]
    one, two = (quality.classify(docs, spark.createDataFrame(r, "doc_id long, quality int")).orderBy("doc_id").collect() for r in (rows, turned))
    assert [r["score"] for r in one] == [r["score"] for r in two]


def test_repeated_rows_are_learned_from_once(spark):
    rows = [(1, "the same")] * 300 + [(2, f"text {k}") for k in range(50)] + [(k, f"of {k}") for k in range(3, 9)] + [(9, None), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 10)], "doc_id long, quality int")
    for bound in (9, 12):
        found = [(r["doc_id"], r["text"] or "") for r in quality.training_rows(docs, labels, bound).collect()]
        assert len(found) == len(set(found)) == bound and {d for d, _ in found} == set(range(1, 10))
    assert len(quality.fit(docs, labels, 12).points) == 12
    assert quality.training_rows(docs, labels, 4096).count() == 58


def test_quality_without_labels_or_rows(spark, docs, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.classify(docs, labels).collect()} == {0.5}
    assert quality.classify(empty, labels).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_votes_are_exact_neighbours():
    rng = np.random.default_rng(3)
    terms, labels = rng.random((40, quality.WIDTH), dtype=np.float32), rng.integers(0, 2, 40)
    model = quality.fit_arrays(terms, labels, axes=8)
    points = quality.vectors(rng.random((9, quality.WIDTH), dtype=np.float32), model)
    for point, score in zip(points, quality.vote(points, model, 5, block=4), strict=True):
        cosines = (model.points @ point).astype(float)
        near = np.argsort(-cosines)[:5]
        weight = np.maximum(cosines[near], 1e-6) ** 8
        assert score == pytest.approx((weight * labels[near]).sum() / weight.sum(), rel=1e-4)


# ---- n-gram join ------------------------------------------------------------------------------

_LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _shingles(text: str | None) -> frozenset:
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(_LOW))
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def _joined(rows):
    sets = [_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    return [(d, len(sets[i]), min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)]


@pytest.mark.parametrize("block", [1024, 2])
def test_ngram_join(docs, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    found = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(docs).collect()]
    assert _sorted(found) == _sorted(_joined(ROWS))


@pytest.mark.parametrize("leaders", [1, 32])
def test_ngram_join_of_tiles_with_many_blocks(spark, monkeypatch, leaders):
    """Near copies of a text, chains that drift away from it, and sets that only share rare shingles with it."""
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "LEADERS", leaders)
    rng = random.Random(31)
    words = _sentence(rng, 80).split()
    rows = []
    for k in range(90):
        own = list(words)
        own[rng.randrange(80)] = f"x{k}"
        rows.append((k, " ".join(own)))
    drifting = list(words)
    for k in range(30):
        drifting[2 * k + 5] = f"y{k}"
        rows.append((200 + k, " ".join(drifting)))
    rows += [(300 + k, " ".join([*words[: 40 + k % 9], *_sentence(rng, 36).split()])) for k in range(40)]
    found = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert _sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == _sorted(_joined(rows))


def test_near_copies_meet_in_about_as_many_rows(spark):
    """A tile of one component: its blocks do not meet again."""
    members = spark.range(5000).select(F.lit(1).alias("root"), F.lit(2).alias("tile"), F.col("id").alias("set_id"), F.lit(5).alias("blocks"))
    first = ngram_join.first_meetings(members)
    assert 5000 <= first.count() <= 5000 + 5 * ngram_join.LEADERS
    connected = members.select(F.col("set_id").alias("node"), F.lit(0).cast("long").alias("root"))
    assert ngram_join.second_meetings(members, connected).isEmpty()
    apart = ngram_join.second_meetings(members, connected.filter("node > 2"))  # two sets beside it
    assert apart.count() <= 5000 + 2 * 6


def test_one_of_each(docs, empty):
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    wanted = {(d, t) for (d, t), (_, _, c) in zip(ROWS, _joined(ROWS), strict=True) if d == c}
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(wanted)
    assert ngram_join.near_duplicates(empty).count() == 0 and ngram_join.one_of_each(empty).count() == 0


def test_ngram_join_where_nothing_is_shared(spark):
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(1200)]
    apart = [(k, " ".join(words[40 * k : 40 * k + 40])) for k in range(30)]
    for rows in (apart[:1], apart[:2], apart, [*apart, (99, apart[4][1] + " more")]):
        found = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert _sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == _sorted(_joined(rows))


def test_bit_counts_bound_overlaps():
    rng = np.random.default_rng(5)
    for bits in (64, 256):
        sets = [np.unique(rng.integers(0, 400, rng.integers(1, 90))).astype(np.uint64) for _ in range(60)]
        maps, sizes = ngram_join.bitmaps(sets, bits), np.array([len(s) for s in sets])
        for i, s in enumerate(sets):
            near = ngram_join.within_bound(maps[i], len(s), maps, sizes)
            for k, other in enumerate(sets):
                both = len(set(s.tolist()) & set(other.tolist()))
                assert ngram_join.overlap(s, other) == both
                if 100 * both >= 75 * (len(s) + len(other) - both):
                    assert near[k]


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(k, k + 1) for k in range(100, 160)]
    root = {x: x for pair in links for x in pair}
    for _ in range(len(root)):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    found = components(spark.createDataFrame(links, "a long, b long"))
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {r["node"]: r["root"] for r in found.collect()} == {x: r for x, r in root.items() if x in linked}


# ---- contamination ----------------------------------------------------------------------------


def _contaminated(rows, items, window=10):
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    known = defaultdict(set)
    for item, text in items:
        words = pattern.findall((text or "").translate(_LOW))
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            known[tuple(words[k : k + size])].add(item)
    out = []
    for doc, text in rows:
        words, hit, found = pattern.findall((text or "").translate(_LOW)), set(), set()
        for size in {len(w) for w in known}:
            for k in range(len(words) - size + 1):
                if tuple(words[k : k + size]) in known:
                    hit |= set(range(k, k + size))
                    found |= known[tuple(words[k : k + size])]
        out.append((doc, len(words), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def test_contamination(spark, docs, empty):
    words = [t.split() for _, t in ROWS if t and len(t.split()) > 80]
    items = [(1, " ".join(words[0][20:45])), (2, " ".join(words[3][5:15]).upper()), (10, "changed"), (11, "two, words!"), (12, None), (13, " . ")]
    items += [(14, " ".join(words[5][:12])), (14, " ".join(words[5][:12])), (15, _sentence(random.Random(99), 40)), (None, " ".join(words[6][30:41]))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = contamination.contamination(docs, benchmark).collect()
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found]
    wanted = _contaminated(ROWS, items)
    assert _sorted(got) == _sorted(wanted)
    assert all(r["contaminated"] == (r["n_hit"] > 0) and r["n_items"] == len(r["items"]) for r in found)
    clean = contamination.clean(docs, benchmark)
    assert clean.columns == docs.columns
    assert Counter(r["text"] for r in clean.collect()) == Counter(t for (_, t), w in zip(ROWS, wanted, strict=True) if not w[2])
    assert contamination.contamination(empty, benchmark).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r["n_hit"] for r in contamination.contamination(docs, none).collect()} == {0}


def test_winnowing_keeps_one_of_every_window():
    rng = np.random.default_rng(6)
    for _ in range(50):
        hashes = rng.integers(0, 9, 40).astype(np.uint64)
        kept = set(contamination.winnow(hashes, 6).tolist())
        assert all(kept & set(range(k, k + 6)) for k in range(35))


# ---- sharding ---------------------------------------------------------------------------------


@pytest.mark.parametrize("copies", [0, 300])
def test_sharding(spark, docs, copies):
    rows = [*ROWS, *((1000 + k, "hot") for k in range(copies))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sharding.shard(frame).collect()
    assert _sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == _sorted(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows
    )
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1
    if copies:  # a group beyond the quota lies in as few shards as hold it, or one more
        hot = {r["shard"] for r in found if r["text_crc32"] == zlib.crc32(b"hot")}
        assert len(hot) <= math.ceil(copies / min(sizes)) + 1


@pytest.mark.parametrize("linked", [1800, 2000])
def test_sharding_cuts_few_groups_when_most_rows_have_copies(spark, linked):
    rng, texts = random.Random(9), []
    while len(texts) < linked - 12:
        texts += [f"group {len(texts)}"] * rng.randint(2, 12)
    texts += ["the last"] * (linked - len(texts))
    texts += [f"single {k}" for k in range(2000 - linked)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found, sizes = defaultdict(set), Counter()
    for r in sharding.shard(frame).collect():
        found[texts[r["doc_id"]]].add(r["shard"])
        sizes[r["shard"]] += 1
    assert set(sizes.values()) == {125}
    cut = sum(len(shards) > 1 for shards in found.values())
    assert cut == 0 if linked < 2000 else cut < 16


def test_rows_change_places_between_full_shards():
    assert sharding.circulation({(0, 1): 5, (1, 0): 3}, [0, 0]) == {(0, 1): 3, (1, 0): 3}
    assert sharding.circulation({(0, 1): 5, (1, 2): 4, (2, 0): 9}, [0, 0, 0]) == {(0, 1): 4, (1, 2): 4, (2, 0): 4}
    assert sharding.circulation({(0, 1): 5, (1, 2): 4}, [0, 0, 2]) == {(0, 1): 2, (1, 2): 2}
    assert sharding.circulation({(0, 1): 5, (1, 2): 4}, [0, 0, 0]) == {}


def test_sharding_of_nothing(empty):
    assert sharding.shard(empty).count() == 0


# ---- fingerprints and licences ----------------------------------------------------------------


def _edited(rows):
    order = sorted(set(rows), key=lambda r: (r[0] is None, -(r[0] or 0), [-b for b in hashlib.md5((r[1] or "").encode()).hexdigest().encode()]))
    order = list(dict.fromkeys((d, t or "") for d, t in order))
    after = {row: order[(k + 1) % len(order)] for k, row in enumerate(order)}
    out = []
    for d, t in rows:
        text, head = t or "", after[d, t or ""][1]
        k = len(text) // 3
        edited = text[: len(text) - k] + head[:k]
        out.append((d, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return out


def test_fingerprints(docs, empty):
    found = spotsigs.fingerprints(docs).withColumn("sha", F.sha2(F.col("edited").cast("binary"), 256))
    own, edited = F.col("signatures"), F.col("edited_signatures")
    found = found.withColumn("near", spotsigs.likeness(own, edited)).withColumn("print", spotsigs.as_text(own)).collect()
    assert _sorted((r["doc_id"], r["n_chars"], r["sha"]) for r in found) == _sorted(_edited(ROWS))
    for r in found:
        a, b = set(r["signatures"]), set(r["edited_signatures"])
        assert a and r["near"] == pytest.approx(len(a & b) / len(a | b)) and len(r["print"]) == 8 * len(a)
    assert spotsigs.fingerprints(empty).count() == 0


def test_signatures_follow_common_words(spark):
    rows = [("The cat of house sat. End",), ("the CAT, of the house!! sat end",), ("nothing common",), (None,)]
    found = [r[0] for r in spark.createDataFrame(rows, "t string").select(spotsigs.signatures(F.col("t"))).collect()]
    assert found[0] == found[1] and len(found[0]) == 2 and len(found[2]) == len(found[3]) == 1 and found[2] != found[3]


def _chains(text):
    """Signatures of a text by walking over its words: pairs of content words behind each run of common ones."""
    plain = re.sub(r"[^0-9a-z\x80-\U0010FFFF]+", " ", (text or "").lower()).split()
    common = set(spotsigs.ANCHORS)
    content = [w for w in plain if w not in common]
    chains, before = set(), 0
    for w in plain:
        if w in common and before + 2 <= len(content):
            chains.add(" ".join(content[before : before + 2]))
        before += w not in common
    return chains


def test_signatures_are_those_of_a_walk_over_the_words(spark):
    rng = random.Random(12)
    words = [*spotsigs.ANCHORS[:9], "cat", "dog", "über", "12", "thé", "theory", "a1"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(300)]
    texts += [re.sub(" ", lambda _: rng.choice([" ", ", ", "\n", " # "]), t.title()) for t in texts[:50]]
    texts += ["the", "the of", "cat the", "the cat", "the cat dog", "cat dog", "# the # cat # dog"]
    chains = {c for t in texts for c in _chains(t)}
    hashes = spark.createDataFrame([(c,) for c in sorted(chains)], "c string").select("c", spotsigs._hashed(F.col("c")))
    number = dict(map(tuple, hashes.collect()))
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", spotsigs.signatures(F.col("t"))).collect()
    bare = 0
    for text, own in found:
        if wanted := _chains(text):
            assert own == sorted({number[c] for c in wanted}), text
        else:
            bare += 1
            assert len(own) == 1
    assert bare > 5 and len(found) > 300


@pytest.mark.parametrize("text", ["the " * 200_000, "the of cat " * 100_000, "cat " + "and the " * 100_000 + "dog", "cat " * 200_000])
def test_signatures_take_linear_time(spark, text):
    frame = spark.createDataFrame([(text,)], "t string").select(spotsigs.signatures(F.col("t")))
    frame.collect()
    start = time.monotonic()
    frame.collect()
    assert time.monotonic() - start < 5


def test_similar_sets_of_signatures(docs):
    members, pairs = spotsigs.similar(docs, 0.6)
    sets = {}
    for r in docs.select("text", spotsigs.signatures(F.col("text")).alias("s")).collect():
        sets[tuple(r["s"])] = r["text"]
    keys = list(sets)
    likes = [len(set(a) & set(b)) / len(set(a) | set(b)) for k, a in enumerate(keys) for b in keys[:k]]
    assert members.count() == len(ROWS) and members.select("class").distinct().count() == len(keys)
    assert sorted(r["likeness"] for r in pairs.collect()) == pytest.approx(sorted(x for x in likes if x >= 0.6))


def test_licences(spark, empty):
    rng = random.Random(8)
    rows, wanted = [], []
    for k, (name, text) in enumerate(licenses.TEMPLATES):
        rows.append((k, f"{_sentence(rng, 37 + k)}\n{text.upper()}.\n{_sentence(rng, 50)}"))
        wanted.append((k, [name]))
    words = licenses.plain_words(licenses.TEMPLATES[1][1])
    rows += [(90, " ".join(words[:4])), (91, None), (92, ""), (93, _sentence(rng, 3000)), (94, rows[0][1] + " " + rows[2][1])]
    wanted += [(90, []), (91, []), (92, []), (93, []), (94, ["Apache-2.0", "MIT"])]
    cut = len(words) - 3  # all but the last shingles: 0.83 of the template
    rows.append((95, f"{_sentence(rng, 20)} {' '.join(words[:cut])} {_sentence(rng, 20)}"))
    wanted.append((95, ["Apache-2.0"]))
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["licenses"]) for r in found) == sorted(wanted)
    share = {r["doc_id"]: r["containment"] for r in found}
    own = len(words) - 4
    assert share[0] == 1 and share[93] == 0 and share[95] == pytest.approx((own - 3) / own)
    assert licenses.scan(empty).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(empty, [("x", "too short")])


# ---- tokens -----------------------------------------------------------------------------------


def _ids(text: str | None) -> list[int]:
    from tokenizers import Tokenizer

    return [*Tokenizer.from_file(tokenizer_file()).encode(text or "", add_special_tokens=False).ids, 2]


def test_encoder_equals_the_library():
    odd = ["a <|endoftext|> b's it's  x\t y\n\n z\x00 q", "é x  yy 12ab ab12. \x00", "x×y. ÷a.  b", "\na.\n", "word—. word—"]
    odd += ["..", " a　 b", "Äpfel, é. ÿ, straße) 3é.", "日本 ab. ²x don't' 'tis", "a \n b", "ªº."]
    texts = [*odd, *(t for _, t in ROWS)]
    encoder = Encoder(tokenizer_file(), 2)
    encoder.MOST = 50
    for _ in range(2):
        for part in (texts[:20], texts[20:], texts):
            ids, offsets = encoder.encode(pa.array(part, pa.string()))
            assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [_ids(t) for t in part]


def _runs_on(rows):
    """Documents lie one behind the other, in ascending order of ids, null ids first."""
    at, last = 0, None
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at and (last is None or (r["doc_id"] is not None and r["doc_id"] >= last))
        at, last = at + r["n_tokens"], r["doc_id"]


@pytest.mark.parametrize("hot", [7, None])
def test_token_index_splits_an_id_that_many_rows_share(spark, hot):
    texts = [f"text {k % 50}" for k in range(3000)]
    table = [(3, "three"), (9, "nine"), (9, "another nine"), *[(hot, t) for t in texts]]
    folder = new_folder(spark, "tokens")
    frame = spark.createDataFrame(table, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one task's
    try:
        token_index.write_shards(frame, folder, tokenizer_file(), chunk_tokens=2000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shards = token_index.read_shards(spark, folder)
    sizes = [r["n_tokens"] for r in shards.select("n_tokens").collect()]
    assert max(sizes) < 2100 and shards.select("part").distinct().count() > 1
    rows = token_index.documents(shards).collect()
    _runs_on(rows)
    sums = {t: zlib.crc32(np.array(_ids(t), "<u4").tobytes()) for t in {t for _, t in table}}
    assert _sorted((r["doc_id"], r["ids_crc32"]) for r in rows) == _sorted((d, sums[t]) for d, t in table)
    assert [r["doc_id"] for r in token_index.lookup(shards, [3, 9, 11], 1).collect()] == [9]
    assert sorted(r["doc_id"] for r in token_index.lookup(shards, [3, 9, 11]).collect()) == [3, 9]
    if hot is not None:
        of_turn = [token_index.lookup(shards, [hot], k).collect() for k in (0, 1499, 2999, 3000)]
        assert [len(x) for x in of_turn] == [1, 1, 1, 0]
        by_start = [r["ids_crc32"] for r in sorted(rows, key=lambda r: r["start"]) if r["doc_id"] == hot]
        for k, x in zip((0, 1499, 2999), of_turn, strict=False):
            assert zlib.crc32(np.array(x[0]["ids"], "<u4").tobytes()) == by_start[k]


def test_token_index(spark, docs, empty):
    folder = new_folder(spark, "tokens")
    token_index.write_shards(docs, folder, tokenizer_file(), chunk_tokens=700)
    shards = token_index.read_shards(spark, folder)
    assert shards.count() > 3
    rows = token_index.documents(shards).collect()
    _runs_on(rows)
    wanted = [(d, len(_ids(t)), zlib.crc32(np.array(_ids(t), "<u4").tobytes())) for d, t in ROWS]
    assert _sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == _sorted(wanted)
    some = {d: t for d, t in ROWS if d in (-5, 22, 100)}
    found = {r["doc_id"]: list(r["ids"]) for r in token_index.lookup(shards, [*some, 10**9]).collect()}
    assert found == {d: _ids(t) for d, t in some.items()}
    token_index.write_shards(empty, f"{folder}-none", tokenizer_file())
    assert token_index.documents(token_index.read_shards(spark, f"{folder}-none")).count() == 0


def test_displacements_are_minimal_and_perfect():
    for n in (1, 2, 3, 50, 2000):
        hashes = token_index.key_hashes(np.arange(n) * 7 - 5, np.ones(n, bool), np.zeros(n, np.int64))
        seeds, slots = token_index.displacements(hashes)
        assert sorted(slots.tolist()) == list(range(n)) and len(seeds) == max(1, n // 3)


def test_packing(docs, empty):
    found = packing.pack_documents(docs, tokenizer_file()).collect()
    ids = [_ids(t) for _, t in ROWS]
    pieces = [(d, k, a, n, zlib.crc32(np.array(x[a : a + n], "<u4").tobytes())) for (d, _), x in zip(ROWS, ids, strict=True) for k, (a, n) in enumerate(packing.cut(len(x), 1024))]
    assert _sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == _sorted(pieces)
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= math.ceil(sum(map(len, ids)) / 1024) + 1
    assert packing.pack_documents(empty, tokenizer_file()).count() == 0


def test_packing_spreads_a_row_that_is_repeated(spark, monkeypatch):
    monkeypatch.setattr(packing, "SEQUENCES_PER_TASK", 16)
    for doc_id in (4, None):
        frame = spark.createDataFrame([(doc_id, "one row of all"), (1, "x")], "doc_id long, text string")
        frame = frame.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(20_000))))
        found = packing.pack_documents(frame, tokenizer_file())
        parts = found.groupBy(F.shiftright("sequence_id", 40).alias("part")).agg(F.count("*").alias("n"), F.sum("length").alias("tokens"), F.countDistinct("sequence_id").alias("seqs")).collect()
        assert sum(r["n"] for r in parts) == 40_000 and len(parts) > 4
        assert max(r["n"] for r in parts) < 2 * min(r["n"] for r in parts)
        assert all(r["seqs"] == math.ceil(r["tokens"] / 1024) or r["seqs"] < r["tokens"] / 1000 + 1 for r in parts)
        places = found.groupBy("sequence_id").agg(F.sum("length").alias("s"), F.max(F.col("offset") + F.col("length")).alias("e"), F.countDistinct("offset").alias("o"), F.count("*").alias("n"))
        assert places.filter("s <> e OR s > 1024 OR o <> n").count() == 0


def test_best_fit_closes_the_fullest():
    bins = packing.Bins(10, 2)
    assert [bins.place(n) for n in (6, 7, 3, 8, 4, 9)] == [(0, 0), (1, 0), (1, 7), (2, 0), (0, 6), (3, 0)]
    assert bins.count == 2
    assert bins.place(5) == (4, 0)  # the one with 1 place closes, not the one with 2
    assert bins.place(2) == (2, 8)
    assert packing.cut(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)] and packing.cut(1024, 1024) == [(0, 1024)]


# ---- archives ---------------------------------------------------------------------------------


def test_arc_to_warc(spark):
    pages = [(5, "http://a/x y", "same"), (2, "http://b", "same"), (9, None, None), (7, "http://c", ""), (8, "u", "é\n\r\n\r\nWARC/1.1\r\n" * 50), (2, "http://b", "same")]
    frame = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, block string").repartition(3)
    arc, out = new_folder(spark, "arc"), new_folder(spark, "warc")
    warc.write_arc(frame, arc)
    warc.convert(spark, arc, out)
    found = warc.read_warc(spark, out, payloads=True).withColumn("page_id", warc.page_key()).collect()
    assert len(found) == len(pages)
    ids = {r["record_id"]: r["page_id"] for r in found}
    first = {}
    for page, _, html in sorted(pages, key=lambda p: p[0]):
        first.setdefault(html or "", page)
    seen = set()
    for r in sorted(found, key=lambda r: (r["page_id"], r["record_type"] != "response")):
        html = next(h or "" for p, _, h in pages if p == r["page_id"])
        raw = html.encode()
        assert r["payload_bytes"] == len(raw) and r["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        again = first[html] != r["page_id"] or html in seen
        seen.add(html)
        assert r["record_type"] == ("revisit" if again else "response")
        assert bytes(r["payload"]) == (b"" if again else raw)
        assert ids.get(r["refers_to"]) == (first[html] if again else None)
    assert {r["date"] for r in found} == {"2024-01-01T00:00:00Z"}


def test_record_ids_follow_from_the_archive_not_its_folder(spark):
    frame = spark.range(40).selectExpr("id % 30 AS page_id", "'http://a' AS url", "concat('page ', id % 7) AS html")
    first, second, moved = (new_folder(spark, f"arc-{k}") for k in range(3))
    warc.write_arc(frame, first)
    warc.write_arc(frame, second)
    shutil.copytree(first, moved)

    def ids(folder):
        return sorted(r[0] for r in warc.read_arc(spark, folder, blocks=False).select("record_id").collect())

    assert ids(first) == ids(second) == ids(moved) and len(set(ids(first))) == 40
    assert warc.archive_name("file:/x/y/2024/a.arc.gz", "/x/y") == "2024/a.arc.gz"
    assert warc.archive_name("s3a://b/x/a.arc.gz", "s3a://b/*") == "a.arc.gz"


def test_arc_empty_table(spark):
    arc, out = new_folder(spark, "arc"), new_folder(spark, "warc")
    warc.write_arc(spark.createDataFrame([], "page_id long, url string, html string"), arc)
    warc.convert(spark, arc, out)
    assert warc.read_warc(spark, out).count() == 0


def test_arc_versions_and_errors():
    block = b"HTTP/1.0 200 OK\r\n\r\nhello"
    one = b"filedesc://x 0.0.0.0 19990101000000 text/plain 20\n1 0 Org\nURL IP ...\n\n"
    one = one.replace(b" 20\n", b" %d\n" % len(b"1 0 Org\nURL IP ...\n"))
    text = one + b"http://a b 1.2.3.4 1999 text/html %d\n" % len(block) + block + b"\n"
    two = b"filedesc://x 0 19990101000000 text/plain 200 - - 0 x 8\n2 0 Org\n\n"
    text += two + b"http://c 1.2.3.4 19990203 text/html 200 abc - 7 x.arc %d\n" % len(block) + block + b"\n"
    found = list(warc.arc_records(text))
    assert [f["URL"] for f, _ in found] == ["http://a%20b", "http://c"] and all(b == block for _, b in found)
    assert warc.warc_date("1999") == "1999-01-01T00:00:00Z" and warc.split_http(block)[1] == b"hello"
    with pytest.raises(ValueError):
        list(warc.arc_records(text[:-10]))
    with pytest.raises(ValueError):
        list(warc.arc_records(one + b"http://a 5\nhello"))


# ---- repeated strings -------------------------------------------------------------------------


def _cut(rows, span):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[s : s + span] for b in raw for s in range(len(b) - span + 1))
    out = []
    for (d, _), b in zip(rows, raw, strict=True):
        gone = np.zeros(len(b) + 1, np.int64)
        for s in range(len(b) - span + 1):
            if seen[b[s : s + span]] > 1:
                gone[s] += 1
                gone[s + span] -= 1
        inside = np.cumsum(gone)[: len(b)] > 0
        runs = int((inside & ~np.concatenate([[False], inside[:-1]])).sum()) if len(b) else 0
        out.append((d, len(b), int(inside.sum()), runs, np.frombuffer(b, np.uint8)[~inside].tobytes()))
    return out


@pytest.mark.parametrize("most_members", [50_000, 1])
def test_suffix_dedup(docs, most_members):
    found = suffix_dedup.without_repeats(docs, span=60, most_members=most_members)
    got = [(r["row"]["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found.collect()]
    assert _sorted(got) == _sorted(_cut(ROWS, 60))


@pytest.mark.parametrize("most_members", [1, 3, 10])
def test_large_groups_are_parted_by_the_bytes_beside_the_anchor(spark, most_members):
    """One passage in many texts, changed at a place of its own in each, and texts that repeat whole."""
    rng = random.Random(17)
    passage, rows = _sentence(rng, 40), []
    for k in range(40):
        own = list(passage)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = "#"
        rows.append((k, f"{_sentence(rng, 6)} {''.join(own)} {_sentence(rng, 6)}"))
    rows += [(100, rows[3][1]), (101, rows[5][1] + "!"), (102, passage * 3), (103, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = suffix_dedup.without_repeats(frame, span=90, most_members=most_members).collect()
    got = [(r["row"]["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found]
    assert _sorted(got) == _sorted(_cut(rows, 90))
    words = suffix_dedup.shortened(frame, 12 * suffix_dedup.WORDS.width, most_members, suffix_dedup.WORDS)
    assert _sorted((r["doc_id"], r["text"]) for r in words.collect()) == _sorted(_passages_cut(rows, 12))


def test_shortened_texts(docs, empty):
    found = suffix_dedup.shortened(docs, span=60)
    assert found.columns == docs.columns and suffix_dedup.shortened(empty).count() == 0
    wanted = []
    for (d, t), (_, _, n, _, kept) in zip(ROWS, _cut(ROWS, 60), strict=True):
        text = t if not n else kept.decode(errors="ignore")
        wanted.append((d, text, None if text is None else len(text)))
    assert _sorted((r["doc_id"], r["text"], r["n_chars"]) for r in found.collect()) == _sorted(wanted)


def _passages_cut(rows, words):
    """Texts without passages of so many words that occur anywhere else, by counting them all."""
    found = [list(re.finditer(r"[^\x20\x09-\x0D]+", t or "")) for _, t in rows]
    strings = [[m.group() for m in own] for own in found]
    seen = Counter(tuple(w[k : k + words]) for w in strings for k in range(len(w) - words + 1))
    out = []
    for (d, t), own, w in zip(rows, found, strings, strict=True):
        gone = {p for k in range(len(w) - words + 1) if seen[tuple(w[k : k + words])] > 1 for p in range(k, k + words)}
        ends = [m.start() for m in own] + [len(t or "")]
        kept = (t or "")[: ends[0]] + "".join(t[ends[k] : ends[k + 1]] for k in range(len(w)) if k not in gone)
        out.append((d, t if not gone else kept))
    return out


@pytest.mark.parametrize("words", [8, 51])
def test_repeated_passages(docs, words):
    found = suffix_dedup.without_passages(docs, words)
    assert _sorted((r["doc_id"], r["text"]) for r in found.collect()) == _sorted(_passages_cut(ROWS, words))


def test_thousands_of_spans_in_one_text(spark):
    rng = random.Random(12)
    line = _sentence(rng, 14)
    text = "".join(f"{line} {hashlib.md5(str(k).encode()).hexdigest()} " for k in range(4000))
    found = suffix_dedup.without_repeats(spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string"), span=60)
    got = [(r["row"]["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found.collect()]
    assert _sorted(got) == _sorted(_cut([(1, text), (2, "short")], 60))
    assert max(r[3] for r in got) > 1000


def _common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_best_matches():
    rng = random.Random(3)
    for _ in range(120):
        gram, span = bytes(rng.choices(b"ab", k=32)), rng.randint(33, 50)
        base, sides = bytes(rng.choices(b"ab", k=60)), set()
        for _ in range(rng.randint(2, 14)):
            left, right = bytearray(base[: span - 32]), bytearray(base[: span - 32])
            for side in (left, right):
                for _ in range(rng.randint(0, 2)):
                    side[rng.randrange(len(side))] ^= 1
            sides.add((bytes(left[: rng.randint(0, len(left))]), gram + bytes(right[: rng.choice([len(right), rng.randint(0, len(right))])])))
        lefts, rights = map(list, zip(*sides, strict=True))
        assert [rights[i] for i in suffix_dedup.Suffixes(rights, span).order] == sorted(rights)
        for i, found in enumerate(suffix_dedup.best_matches(lefts, rights, span)):
            wanted = set()
            for j in range(len(lefts)):
                a, b = _common(lefts[i], lefts[j]), _common(rights[i], rights[j])
                if i != j and a + b >= span:
                    wanted |= set(range(-a, b - span + 1))
            assert wanted == {s for a, b in found for s in range(-a, b - span + 1)}


def test_equal_strings_have_equal_anchors():
    rng = random.Random(11)
    text = bytes(rng.choices(b"ab", k=4000)) + b"a" * 500 + b"abc" * 200
    data, offsets = utf8(pa.array([text, text[700:2000], b"", b"a" * 399, text[100:500]]))
    places, hashes = suffix_dedup.anchors(data, offsets)
    known = dict(zip(places.tolist(), hashes.tolist(), strict=True))
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        inside = [p for p in known if a <= p < b]
        assert (b - a < 400) == (not inside), row
    shift = int(offsets[1]) - 700
    assert any(p - shift in known for p in known if offsets[1] <= p < offsets[2])
