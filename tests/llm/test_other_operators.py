"""Token rollup, language id, sharding, fingerprints and URL filter: brute force, held-out accuracy, odd documents."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlake.llm import fingerprint, language_id, queries, sharding, token_rollup, url_filter
from flowlake.llm.queries import tokenizer_path
from flowlake.session import scratch_path
from odd import ROWS, clashing, documents

SMALL = "/root/testdata/sf0.001"


# -- token rollup

def vocabularies():
    import public_tokenizers as P
    return {"word": (tokenizer_path(), None), "byte": (str(P.path("byte_bpe_50k.tiktoken")), P.PATTERN)}


def counters():
    import public_tokenizers as P
    import tiktoken
    from tokenizers import Tokenizer
    word = Tokenizer.from_file(tokenizer_path())
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    byte = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return {"word": lambda t: len(word.encode(t, add_special_tokens=False).ids), "byte": lambda t: len(byte.encode_ordinary(t))}


ODD_TEXTS = ["a  b\n\n c\t\td ", "   ", "it's they'll 'Round 12 345", "x\x1cy\x85z \u00a0 w", "ﬁ Å Ω ΑΣ", "a\r\nb", " lead", "tail  "]


def test_token_counts(spark):
    rows = ROWS + [(500 + i, t, "en", "a") for i, t in enumerate(ODD_TEXTS)]
    got = Counter((r["doc_id"], r["n0"], r["n1"]) for r in token_rollup.token_counts(documents(spark, rows), vocabularies()).collect())
    count = counters()
    assert got == Counter((d, count["word"](t or ""), count["byte"](t or "")) for d, t, *_ in rows)


def test_rollup_of_a_corpus(spark):
    got = {(r["source"], r["lang"], r["version"]): (r["docs"], r["tokens"]) for r in token_rollup.rollup_report(clashing(spark), vocabularies()).collect()}
    count, want, first = counters(), defaultdict(lambda: [0, 0]), {}
    for doc_id, text, *_ in ROWS:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    for doc_id, text, lang, source in ROWS:
        if doc_id is not None and doc_id > first.get(text or "", doc_id):
            continue
        for version in count:
            cell = want[(source, lang, version)]
            cell[0] += 1
            cell[1] += min(4096, count[version](text or ""))
    assert got == {k: tuple(v) for k, v in want.items()}
    assert token_rollup.rollup_report(documents(spark, []), vocabularies()).count() == 0


def test_corpus_totals_are_whole(spark, monkeypatch):
    """What op1_token_counts returns: sums over all rows and whole texts, copies and long documents included."""
    monkeypatch.setattr(queries, "read_table", lambda spark, sf_dir, name: clashing(spark))
    got = {(r["source"], r["lang"], r["version"]): (r["docs"], r["tokens"]) for r in queries.op1_token_counts(spark, "").collect()}
    want = defaultdict(lambda: [0, 0])
    for version, count in zip(("word_bpe_49k", "byte_bpe_50k"), counters().values()):
        for _, text, lang, source in ROWS:
            want[(source, lang, version)][0] += 1
            want[(source, lang, version)][1] += count(text or "")
    assert got == {k: tuple(v) for k, v in want.items()}
    assert max(tokens for _, tokens in got.values()) > 60_000


def test_rollup_commits_once(spark):
    rollup = token_rollup.Rollup(spark, scratch_path(spark, "t-rollup"))
    shape = "source string, lang string, version string, tokens long, sign int"
    came = spark.createDataFrame([("s", "en", "v1", 10, 1), ("s", "en", "v1", 7, 1), (None, None, "v1", 1, 1)], shape)
    went = spark.createDataFrame([("s", "en", "v1", 10, -1), (None, None, "v1", 1, -1), ("s", "en", "v1", 7, -1), ("s", "en", "v1", 9, 1)], shape)
    assert rollup.totals().count() == 0
    assert rollup.apply("one/α", came) and not rollup.apply("one/α", came)
    assert rollup.apply("empty", came.limit(0))
    half = f"{rollup.path}/deltas/two"  # a writer that was lost: files, but no success marker
    came.select("source", "lang", "version", F.lit(9).cast("long").alias("docs"), F.lit(9).cast("long").alias("tokens")).write.parquet(half)
    files, where = rollup._files(), rollup._hadoop(f"{half}/_SUCCESS")
    files.delete(where, False)
    assert {tuple(r) for r in rollup.totals().collect()} == {("s", "en", "v1", 2, 17), (None, None, "v1", 1, 1)}
    assert rollup.apply("two", went)
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "v1", 1, 9)]
    rollup.compact()
    assert not rollup.apply("one/α", came) and not rollup.apply("two", went)  # also after compaction
    assert rollup.apply("three", came)
    rollup.compact()
    assert {tuple(r) for r in rollup.totals().collect()} == {("s", "en", "v1", 3, 26), (None, None, "v1", 1, 1)}


def test_a_batch_committed_during_compaction_counts_once(spark, monkeypatch):
    rollup = token_rollup.Rollup(spark, scratch_path(spark, "t-rollup"))
    shape = "source string, lang string, version string, tokens long, sign int"
    one = spark.createDataFrame([("s", "en", "v1", 10, 1)], shape)
    rollup.apply("a", one)
    plain = token_rollup.Rollup._sum

    def slow(self, number, names):
        monkeypatch.setattr(token_rollup.Rollup, "_sum", plain)
        rollup.apply("b", one)  # after the list of batches was taken, before the snapshot is written
        return plain(self, number, names)

    monkeypatch.setattr(token_rollup.Rollup, "_sum", slow)
    rollup.compact()
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "v1", 2, 20)]
    reading = rollup.totals()  # asked for before the next compaction, read after it
    rollup.compact()
    assert [tuple(r) for r in reading.collect()] == [("s", "en", "v1", 2, 20)]
    rollup.compact()
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "v1", 2, 20)] and not rollup.apply("a", one) and not rollup.apply("b", one)
    assert rollup._done("deltas") == [] and len(rollup._done("snapshots")) == 2


# -- language id

def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r["doc_id"]: r for r in language_id.language_report(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 3 == 1]
    assert {d for d in got if got[d]["held_out"]} == set(held)
    assert sum(got[d]["lang_pred"] == truth[d] for d in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_of_odd_documents(spark):
    got = {r["doc_id"]: r for r in language_id.language_report(clashing(spark)).collect()}
    assert {d: got[d]["lang_pred"] for d in (4, 5, 6)} == {4: "und", 5: "und", 6: "und"} and got[4]["score"] == 0
    assert all(got[d]["lang_pred"] in {"en", "de", "xx"} for d in got if d not in (4, 5, 6))
    none = language_id.language_report(documents(spark, [(1, "some text", None, "a")])).first()
    assert none["lang_pred"] == "und"
    assert language_id.language_report(documents(spark, [])).count() == 0


def test_rare_languages_are_learnt(spark):
    """Six languages of 3000 rows and one of 0.1 %: all of its rows are drawn, and the others keep equal shares."""
    rows = [(i, f"wort {i}", f"l{i % 6}", "a") for i in range(18_000)] + [(100_000 + i, f"seltsam {i}", "rare", "a") for i in range(18)]
    got = Counter(r["lang"] for r in language_id.drawn(documents(spark, rows)).select("lang").collect())
    assert sum(got.values()) == language_id.TRAIN_ROWS and got["rare"] == 18
    assert all(abs(got[f"l{i}"] - 497) < 75 for i in range(6))


def test_rare_languages_of_some_size_keep_their_share(spark):
    rows = [(i, f"wort {i}", f"l{i % 5}", "a") for i in range(25_000)] + [(100_000 + i, f"seltsam {i}", "rare", "a") for i in range(450)]
    got = Counter(r["lang"] for r in language_id.drawn(documents(spark, rows)).select("lang").collect())
    assert got["rare"] == 450


def test_gram_counts_do_not_depend_on_blocks():
    text = "Der schnelle Fuchs über " * 50
    assert (language_id.gram_counts(text) == language_id.gram_counts(text, block=97)).all()


def test_training_is_repeatable_and_calibrated():
    rng = np.random.default_rng(1)
    features, labels = [], []
    for i in range(300):
        buckets = rng.choice(500, 40, replace=False) + 1000 * (i % 3)
        features.append((buckets.astype(np.int32), np.full(40, 1 / 40, np.float32)))
        labels.append(i % 3)
    labels = np.array(labels)
    table, bias = language_id.train(features[:225], labels[:225], 3)
    again, _ = language_id.train(features[:225], labels[:225], 3)
    assert (table == again).all()
    temperature, limit = language_id.calibrate(features[225:], labels[225:], table, bias)
    right = [int((w @ table[b] + bias).argmax()) == y for (b, w), y in zip(features[225:], labels[225:])]
    assert np.mean(right) > 0.95 and temperature > 0 and 0 <= limit <= 1


# -- sharding

def check_shards(got, rows, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    slots, size = defaultdict(list), Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    return size


def test_shards_of_odd_documents(spark):
    check_shards(sharding.shard_report(clashing(spark)).collect(), ROWS, 40)
    assert sharding.shard_report(documents(spark, [])).count() == 0


@pytest.mark.parametrize("hot", [0, 400])
def test_shards_are_near_equal(spark, hot):
    """Sizes differ by the documents at the boundaries only, also where a third of the rows are one text."""
    rng = random.Random(8)
    rows = [(i, "the same text again" if i < hot else "".join(rng.choice("abc ") for _ in range(rng.randint(1, 200))), "en", "a") for i in range(1200)]
    got = sharding.shard_report(documents(spark, rows)).collect()
    size = check_shards(got, rows, 40)
    mean = sum(size.values()) / 40
    assert len(size) == 40 and max(size.values()) - mean < 216 + 0.05 * mean and mean - min(size.values()) < 216 + 0.05 * mean
    again = {r["doc_id"]: r["shard"] for r in sharding.shard_report(documents(spark, rows).repartition(5)).collect()}
    assert again == {r["doc_id"]: r["shard"] for r in got}


def test_repeated_rows_are_split(spark):
    rows = [(1, "x" * 50, "en", "a")] * 800
    size = check_shards(sharding.shard_report(documents(spark, rows), shards=8).collect(), rows, 8)
    assert set(size.values()) == {100 * 66}


# -- fingerprints

def test_fingerprints(spark):
    rng = random.Random(6)
    words = [f"wort{i}" for i in range(300)]
    rows = ROWS + [(600 + i, "\n".join(" ".join(rng.choice(words) for _ in range(8)) + "." for _ in range(rng.randint(1, 60))), "en", "a") for i in range(80)]
    got = fingerprint.fingerprint_report(documents(spark, rows)).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    want = Counter()
    near = {}
    for i, (doc_id, text, *_) in enumerate(order):
        text, other = text or "", order[i - 1][1] or ""
        half = len(text) // 2
        new = text[:len(text) - half] + other[:half]
        want[(doc_id, len(text), hashlib.sha256(new.encode()).hexdigest())] += 1
        near[(doc_id, new)] = tuple(likeness(text, x) for x in (new, other))
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == want
    exact = {(d, hashlib.sha256(new.encode()).hexdigest()): v for (d, new), v in near.items()}
    errors = []
    for r in got:
        one, two = (fingerprint.Published.parse([r[c]]) for c in ("fingerprint", "edited_fingerprint"))
        assert one.text() == [r["fingerprint"]] and one.likeness(two)[0] == r["near_edited"]  # from what is published alone
        errors += [abs(a - b) for a, b in zip((r["near_edited"], r["near_next"]), exact[(r["doc_id"], r["edited_sha256"])])]
    assert max(errors) < 0.1 and sum(errors) / len(errors) < 0.02
    texts = {d: t or "" for d, t, *_ in rows}
    prints = defaultdict(set)
    for r in got:
        prints[texts[r["doc_id"]].strip()].add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    assert fingerprint.fingerprint_report(documents(spark, [])).count() == 0
    alone = fingerprint.fingerprint_report(documents(spark, [(5, "only one. here", "en", "a")])).first()
    assert alone["near_next"] == 1.0


def likeness(a, b):
    """Of the multisets of paragraphs: lines, cut after marks that end a clause; parts without anything else belong to nothing."""
    a, b = (Counter(p.strip() for p in re.findall(r"[^\n.,;:!?|]*[\n.,;:!?|]+|[^\n.,;:!?|]+", t) if p.strip()) for t in (a, b))
    return (a & b).total() / (a | b).total() if a or b else 1.0


def test_published_fingerprints_measure_any_distance():
    rng = np.random.default_rng(9)
    errors = []
    for size, differ in ((0, 0), (0, 3), (5, 2), (400, 3), (40, 40), (300, 100), (1000, 900), (3000, 6000), (20_000, 500), (20_000, 40_000)):
        both = rng.integers(0, 2**63, size).astype(np.uint64)
        one, two = (np.unique(np.concatenate([both, rng.integers(0, 2**63, differ).astype(np.uint64)])) for _ in range(2))
        near = fingerprint.Published.of([one]).likeness(fingerprint.Published.of([two]))[0]
        true = size / (size + 2 * differ) if size + differ else 1.0
        errors.append(abs(near - true))
        if 2 * differ <= 4:  # a difference that the small sketch gives away is exact
            assert near == true
    assert max(errors) < 0.1


def test_fingerprints_of_hot_ids(spark):
    """Null and repeated ids: ranges part rows of one id by their text; every row still finds its neighbour."""
    rows = [(None if i % 3 else 7, f"line {i}.\nand {i % 5}.", "en", "a") for i in range(300)]
    got = fingerprint.fingerprint_report(documents(spark, rows).withColumns({n: F.lit(1) for n in ("part", "halo", "tie", "to", "_key", "_part")})).collect()
    assert len(got) == 300 and Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)


def test_peeling_recovers_differences():
    rng = np.random.default_rng(3)
    for size in (0, 1, 5, 40, 900):
        both = rng.integers(0, 2**63, 500).astype(np.uint64)
        one, two = (np.sort(np.concatenate([both, rng.integers(0, 2**63, size).astype(np.uint64)])) for _ in range(2))
        (left, right), = fingerprint.differences([one], [two])
        assert set(left) == set(one) - set(two) and set(right) == set(two) - set(one)


def test_repeated_paragraphs_count():
    a, b = fingerprint.digests("x.\nx.\nx.\ny."), fingerprint.digests("x.\ny.")
    assert len(a) == 4 and len(b) == 2 and len(np.intersect1d(a, b)) == 2


# -- URL filter

URLS = [
    ("http://EXAMPLE.net/en/1", "example.net", "/en/1", "example.net/en/", "allow"), ("https://a.b.example.net/de/", "a.b.example.net", "/de/", "net/", "block"),
    ("x://notexample.com/de/x?y#z", "notexample.com", "/de/x", None, None), ("http://m.example.com/de/?q", "m.example.com", "/de/", "example.com/de/", "block"),
    ("https://example.net", "example.net", "", None, None), ("https://é.org/fr/a://b", "é.org", "/fr/a://b", "org/fr/", "allow"),
    ("no scheme", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None), ("://", "", "", None, None), ("http://h#x/y", "h", "", None, None),
    ("http://h?x/y", "h", "", None, None), ("http://net/", "net", "/", "net/", "block"), ("http://example.com/DE/", "example.com", "/DE/", None, None),
    ("http://long.org/" + "/".join("s" * 9 for _ in range(400)), "long.org", "/" + "/".join("s" * 9 for _ in range(400)), None, None),
]


def test_rules(spark):
    pages = spark.createDataFrame([(i, u[0], 7) for i, u in enumerate(URLS)] + [(0, URLS[0][0], 7), (None, None, 7)], "page_id long, url string, purity int")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    got = url_filter.judge(pages, none).collect()
    want = Counter((i, *u[1:4], u[4] or "allow") for i, u in enumerate(URLS)) + Counter([(0, *URLS[0][1:4], "allow"), (None, "", "", None, "allow")])
    assert Counter(tuple(r)[:5] for r in got) == want
    assert url_filter.judge(pages.limit(0), none).count() == 0


def test_bad_templates_are_rejected(spark):
    """On one host the branch /ads/<number> is bad; its sisters and the same branch elsewhere are not."""
    rows, bad = [], []
    for i in range(1200):
        host, branch = ("h.com", ["ads", "news", "shop"][i % 3]) if i % 2 else ("g.com", ["ads", "news"][i % 4 // 2])
        rows.append((i, f"http://{host}/{branch}/{i}.html"))
        if i % 5:
            bad.append((i, (host, branch) == ("h.com", "ads") if i % 17 else i % 2 == 0))
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(bad, "page_id long, bad boolean"))
    blocked = {(r["host"], r["path"].split("/")[1]) for r in got.filter("verdict = 'block'").collect()}
    assert blocked == {("h.com", "ads")}
    assert got.filter("verdict = 'block'").count() == sum("h.com/ads" in u for _, u in rows)


def blocked(spark, rows):
    """Addresses that are blocked, from (address, bad or None) with one page a row."""
    pages = spark.createDataFrame([(i, f"http://{u}") for i, (u, _) in enumerate(rows)], "page_id long, url string")
    marks = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(rows) if b is not None], "page_id long, bad boolean")
    got = url_filter.judge(pages, marks, rules=[])
    assert got.count() == len(rows)
    return {f"{r['host']}{r['path']}" for r in got.filter("verdict = 'block'").collect()}


def test_small_bad_directories_are_rejected(spark):
    """Under 1 % of a host's pages, alone among good directories, and 20 of 200 equal ones."""
    one = [(f"h.com/main/{i}", False) for i in range(8000)] + [(f"h.com/good{chr(97 + i % 20)}/{i}", False) for i in range(1000)]
    one += [(f"h.com/evil/{i}", True) for i in range(80)]
    assert blocked(spark, one) == {u for u, bad in one if bad}
    many = [(f"h.com/{chr(97 + i // 20)}{chr(97 + i % 20)}x/{k}", i % 10 == 3) for i in range(200) for k in range(40)]
    assert blocked(spark, many) == {u for u, bad in many if bad}


def test_small_good_directories_are_kept_and_bad_ones_judged_together(spark):
    rows = [(f"h.com/main/{i}", False) for i in range(8000)]
    bad = [(f"h.com/{chr(97 + i // 20)}{chr(97 + i % 20)}x/{k}", True) for i in range(200) for k in range(8)]
    good = [(f"h.com/fine/{k}", False) for k in range(60)]
    assert blocked(spark, rows + bad + good) == {u for u, _ in bad}  # few labels each, but many together


def test_deep_templates_are_told_apart(spark):
    top = "/".join("abcdefghijk")
    rows = [(f"h.com/{top}/{['ads', 'news'][i % 4 == 0]}/{i}", i % 4 == 0) for i in range(800)]
    rows += [(f"g.com/{i}", False) for i in range(2000)] + [("h.com/" + "/".join("s" * 300), None)]
    assert blocked(spark, rows) == {u for u, bad in rows if bad}


def test_stars_in_paths_are_segments(spark):
    rows = [(f"h.com/*/{i}", True) for i in range(300)] + [(f"h.com/{chr(97 + i % 20)}{chr(97 + i // 20)}/x", False) for i in range(400)]
    rows += [(f"g.com/{i}", False) for i in range(2000)]
    assert blocked(spark, rows) == {u for u, bad in rows if bad}
