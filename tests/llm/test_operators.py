"""The operators on small fixtures: brute force, round trips, held-out accuracy, edge rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from comparing import assert_same
from nightfolio.llm import (
    blob_ledger,
    decontaminate,
    embedding_lsh,
    jaccard_join,
    languages,
    masked_lm,
    packing,
    pii,
    transcripts,
    warc,
)
from nightfolio.llm import queries as llm
from nightfolio.llm.common import WordCodes, components

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, spans string, node long"


def sentence(rng, words, size):
    return " ".join(rng.choice(words) for _ in range(size))


@pytest.fixture(scope="module")
def words():
    rng = random.Random(3)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]


@pytest.fixture(scope="module")
def docs(spark, words):
    """Nulls, empty and very long texts, copies, near copies of one text, clashing names."""
    rng = random.Random(5)
    base = sentence(rng, words, 120).split()
    texts = [None, "", "   ", "one two", "one two", "x" * 20_000, "4 !!", sentence(rng, words, 30_000)]
    texts += [" ".join(base)] * 40
    for edits in list(range(1, 12)) * 4:
        near = list(base)
        for _ in range(edits):
            near[rng.randrange(len(near))] = rng.choice(words)
        texts.append(" ".join(near))
    texts += [sentence(rng, words, rng.randint(5, 200)) for _ in range(60)]
    rows = [(i, t, "en", "s", 1, "clash", 7) for i, t in enumerate(texts)]
    rows += [(3, "one two", "en", "s", 1, "clash", 7), (None, texts[60], None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def test_word_codes_follow_words():
    texts = ["A b  a", "", None, "é\tB\x0bb", "y" * 3_000_000 + " z", "É “q”,x"]
    plain = WordCodes().of(pa.array(texts))
    assert [len(c) for c in plain] == [3, 0, 0, 3, 2, 2]
    assert plain[0][0] == plain[0][2] and plain[0][1] == plain[3][1] == plain[3][2]
    lettered = decontaminate.plain_words().of(pa.array(texts))
    assert [len(c) for c in lettered] == [3, 0, 0, 3, 2, 3]
    assert lettered[3][0] == lettered[5][0]


def brute_components(rows, links):
    parent = {i: i for i in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {i: find(i) for i in rows}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 480)]
    found = {r[0]: r[1] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for pair in links if pair[0] != pair[1] for x in pair}
    expected = brute_components(nodes, [p for p in links if p[0] != p[1]])
    assert found == expected


def brute_jaccard(rows):
    sets = defaultdict(set)
    sizes = {}
    for i, text in rows:
        found = (text or "").encode().lower().split()
        own = {tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))} if found else set()
        sets[i] |= own
        sizes[i] = len(own)
    named = [i for i in sets if sets[i]]
    links = []
    for k, a in enumerate(named):
        for b in named[:k]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    return sizes, brute_components(sets, links)


@pytest.mark.parametrize("crowd, tile", [(8, 2048), (2, 8)])
def test_jaccard_join(spark, docs, monkeypatch, crowd, tile):
    monkeypatch.setattr(jaccard_join, "CROWD", crowd)
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    found = jaccard_join.join_components(docs).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert len(found) == len(rows)
    sizes, expected = brute_jaccard([r for r in rows if r[0] is not None])
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["n_shingles"] > 0
        else:
            assert (r["n_shingles"], r["component_id"]) == (sizes[r["doc_id"]], expected[r["doc_id"]])


def test_jaccard_join_of_nothing(spark, docs):
    assert jaccard_join.join_components(docs.limit(0)).collect() == []


def test_documents_of_one_id_share_a_component(spark):
    rows = [(1, "a b c d e f"), (1, "g h i j k l"), (0, "g h i j k l"), (5, "a b c d e f"), (9, "z")]
    found = jaccard_join.join_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r[0], r[2]) for r in found.collect()} == {(1, 0), (0, 0), (5, 0), (9, 9)}


def test_keep_one(docs):
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    _, expected = brute_jaccard([(r[0], r[1]) for r in docs.collect() if r[0] is not None])
    assert Counter(ids) == Counter([i for i in expected if expected[i] == i] + [None])


BASE = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def brute_pii(text):
    found = [(0, *m.span()) for m in BASE[0].finditer(text)]
    found += [(1, *m.span()) for m in BASE[1].finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in BASE[2].finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            found.append((2, *m.span()))
    found += [(3, *m.span()) for m in BASE[3].finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return found


def test_base_spans_equal_plain_patterns():
    rng = random.Random(2)
    for _ in range(20_000):
        text = "".join(rng.choice("0123456789.. @ab+-()%1é") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == brute_pii(text), text


def test_further_spans_overlap_none_before():
    """Against a comparison with every span taken before."""
    rng = random.Random(3)
    parts = ["(212) 555-0147", "123-45-6789", "a.b@c.de", "Dr. Ann Lee", "4111 1111 1111 1111",
             "DE89 3704 0044 0532 0130 00", "me [at] x [dot] org", " ", " 555 ", "+1 212 555 0147"]
    for _ in range(300):
        text = " ".join(rng.choices(parts, k=8))
        base = pii.base_spans(text)
        found = pii.further_spans(text, base)
        used = [span[1:] for span in base]
        for _, start, end in found:
            assert all(end <= a or b <= start for a, b in used)
            used.append((start, end))
        everything = pii.further_spans(text, [])
        assert {s for s in everything if all(s[2] <= a or b <= s[1] for a, b in used)} <= set(found)


def test_many_spans_and_joined_tokens_end():
    text = "a@b.cd (212) 555-0147 " * 60_000
    assert len(pii.proposed(text)) == 120_000
    jwt = next(rule for rule in blob_ledger.RULES if rule[0] == "jwt")
    assert not blob_ledger.spans_of("eyJ-" * 300_000, re.compile(jwt[2]), *jwt[3:])
    one = f"{'eyJ' + 'a' * 9}.{'b' * 9}.{'c' * 9}"
    assert blob_ledger.spans_of(f"x {one} y", re.compile(jwt[2]), *jwt[3:]) == [
        {"first": 2, "last": 2 + len(one)}
    ]


def test_long_digits_end():
    assert pii.base_spans("1" * 200_000 + "." * 3) == []
    assert pii.base_spans("0" * 5000 + "1.2.3.4") == [(1, 0, 5007)]


def test_reliabilities_find_the_good_labelers():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.3
    ballots = np.empty((4000, pii.LABELERS), int)
    for k, right in enumerate([0.95, 0.9, 0.85, 0.8, 0.6, 0.55]):
        vote = np.where(rng.random(4000) < right, truth, ~truth)
        ballots[:, k] = np.where(rng.random(4000) < 0.2, 0, vote + 1)
    share, chance, posterior = pii.reliabilities(ballots, np.ones(4000))
    assert abs(share[1] - 0.3) < 0.05
    assert chance[0, 1, 2] > chance[3, 1, 2] > chance[5, 1, 2]
    assert ((posterior > 0.5) == truth).mean() > 0.95


def card(rng, valid):
    digits = rng.choice("3456") + "".join(rng.choice("0123456789") for _ in range(14))
    last = next(d for d in "0123456789" if pii.luhn(digits + d))
    return digits + (last if valid else str((int(last) + 5) % 10))


def planted(rng, number):
    """A text with one span beside base matches, its kind, and whether it is personal."""
    phone = f"+1 ({rng.randint(200, 900)}) 555-{rng.randint(1000, 9999)}"
    ip = ".".join(str(rng.randint(11, 250)) for _ in range(4))
    kind = number % 7
    if kind == 0:  # a phone and an address that one pattern takes for a number too long
        return f"so {phone} {ip} it was", "phone_number", phone, True
    if kind == 1:  # two cards that one pattern takes for a number too long
        one, two = card(rng, True), card(rng, True)
        return f"took {one} {two} there", "card_number", one, True
    if kind == 2:
        one = card(rng, False)
        return f"counted {one} grains", "card_number", one, False
    if kind == 3:  # all but the checksum speak for it
        one = card(rng, False)
        return f"my credit card {one} was not one", "card_number", one, False
    if kind == 4:
        return f"Dear {rng.choice(['John Ash', 'Maria Reed', 'Hans Berg'])}, hello", "name", None, True
    if kind == 5:
        return f"Wide Valley was green and mail a{number}@b.com", "name", "Wide Valley", False
    return f"call {phone} or see 300.{rng.randint(1, 99)}.4.5 now", "dotted_quad", None, False


def test_the_classifier_decides_and_beats_the_majority():
    rng = random.Random(41)
    cases = [planted(rng, i) for i in range(700)]
    spans, combos = [], Counter()
    for text, kind, piece, personal in cases:
        found = pii.proposed(text)
        combos.update(s["combination"] for s in found)
        own = [s for s in found if pii.KINDS[s["kind"]] == kind and piece in (None, text[s["first"] : s["last"]])]
        assert own, (text, kind)
        spans.append((text, own[0], personal))
    numbers = np.array(sorted(combos))
    accepted = pii.fit(numbers, np.array([combos[n] for n in numbers]))
    assert accepted and accepted != set(numbers.tolist())
    right = sum((s["combination"] in accepted) == personal for _, s, personal in spans)
    for tie in (True, False):
        majority = 0
        for text, s, personal in spans:
            ballot = pii.votes(text, s["kind"], s["first"], s["last"])
            lead = ballot.count(2) - ballot.count(1)
            majority += (lead > 0 or lead == 0 and tie) == personal
        assert right > majority + 50
    assert right >= 0.95 * len(spans)


def test_near_misses_are_cut_at_base_spans():
    text = "x +1 (826) 555-4081 190.137.223.204 7536784127813050 4845168114407329, 1.2.3.999"
    found = [(pii.KINDS[s["kind"]], text[s["first"] : s["last"]]) for s in pii.proposed(text)]
    assert ("phone_number", "+1 (826) 555-4081") in found and ("ip", "190.137.223.204") in found
    assert ("card_number", "4845168114407329") in found and ("dotted_quad", "1.2.3.999") in found
    assert list(pii._left(2, 9, [(0, 3), (5, 6), (8, 20)])) == [(3, 5), (6, 8)]
    assert list(pii._left(2, 9, [])) == [(2, 9)]
    long = "Dear John Ash " + "1" * 100_000 + " " + "Up " * 50_000
    assert ("name", "John Ash") in [(pii.KINDS[s["kind"]], long[s["first"] : s["last"]]) for s in pii.proposed(long)]


def test_pii_query_and_redaction(spark):
    rows = [
        (1, "Call phone +1 (017) 555-7713 or mail a.b@mail.example.com now"),
        (2, None), (3, ""), (None, "ip 10.1.2.3"), (5, "write to jane [at] example [dot] org, ssn 123-45-6789"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", pii.F.lit(0))
    found = {r["doc_id"]: r for r in pii.find(docs).collect()}
    assert found[1]["spans"] == "phone:11:28,email:37:57" and found[1]["n_phone"] == 1
    assert found[2]["spans"] == "" == found[3]["spans"]
    assert found[2]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert found[None]["n_ip"] == 1
    assert "masked_email" in found[5]["spans"] and "ssn" in found[5]["spans"]
    clean = {r["doc_id"]: r for r in pii.redact(docs).collect()}
    assert clean[1]["text"] == "Call phone [PHONE] or mail [EMAIL] now"
    assert clean[1]["n_chars"] == len(clean[1]["text"]) and clean[2]["text"] is None
    assert pii.find(docs.limit(0)).collect() == []


def test_packing_covers_every_token(spark, docs):
    rows = packing.packed(docs.repartition(3)).collect()
    encoder = packing.Encoder(packing.default_tokenizer())
    texts = defaultdict(list)
    for r in docs.collect():
        ids = encoder.slow.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        texts[r["doc_id"]].append(ids)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, several in texts.items():
        assert sum(r["length"] for r in pieces[doc]) == sum(map(len, several))
        for r in pieces[doc]:
            parts = [ids[r["start"] : r["start"] + r["length"]] for ids in several if len(ids) == r["doc_tokens"]]
            assert r["ids_crc32"] in {zlib.crc32(np.array(p, "<u4").tobytes()) for p in parts}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0
    assert packing.packed(docs.limit(0)).collect() == []


@pytest.mark.parametrize("text", [" " * 100_000, "a" * 50_000, "x<|endoftext|>y", "\n" * 9000 + "a  b", "😀é"])
def test_token_ids_equal_the_library(text):
    encoder = packing.Encoder(packing.default_tokenizer())
    assert encoder(text).tolist() == encoder.slow.encode(text, add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("run", [" " * 2_000_000, "\n" * 1_100_000, " \t\r\n" * 300_000])
def test_long_white_space_between_letters(spark, run):
    encoder = packing.Encoder(packing.default_tokenizer())
    text = f"x{run}y z"
    assert encoder(text).tolist() == encoder.slow.encode(text, add_special_tokens=False).ids + [1]
    rows = packing.packed(spark.createDataFrame([(1, text), (2, "a b")], "doc_id long, text string"))
    assert {r["doc_id"]: r["doc_tokens"] for r in rows.collect()} == {1: len(encoder(text)), 2: len(encoder("a b"))}


def test_pack_balances_cost():
    pieces, count = packing.pack([900, 800, 700, 600, 500, 400, 300, 200] * 20)
    load = np.zeros(count)
    for _, _, length, sequence, _ in pieces:
        load[sequence] += packing.cost(length)
    assert len(pieces) < 8 * 20 + 2 * count and load[:40].std() < 0.2 * load[:40].mean()


def test_spaced_seeds(spark, words):
    rng = random.Random(9)
    items = [sentence(rng, words, n) for n in (15, 20, 40, 4)] + [None, ""]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    changed = items[2].split()
    for place in (6, 17, 29):
        changed[place] = "other"
    rows = [
        (1, f"{sentence(rng, words, 50)} {items[0].upper()}, {sentence(rng, words, 9)}"),
        (2, " ".join(changed)),
        (3, sentence(rng, words, 300)), (4, None), (5, ""), (None, items[1]),
        (6, items[1]), (6, items[1]),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.overlaps(docs, bench).collect()
    by_join = decontaminate.overlaps(docs, bench, limit=1).collect()
    assert sorted(found) == sorted(by_join)
    assert {(r["doc_id"], r["item_id"], r["n_words"], r["n_equal"]) for r in found} == {
        (1, 0, 15, 15), (2, 2, 40, 37), (6, 1, 20, 20)
    }
    kept = decontaminate.keep_clean(docs.filter("doc_id is not null"), bench)
    assert {r["doc_id"] for r in kept.collect()} == {3, 4, 5}
    assert decontaminate.overlaps(docs, bench.limit(0)).collect() == []


@pytest.mark.parametrize("size", [12, 13, 15])
def test_one_exchanged_word_anywhere_hides_no_item(spark, words, size):
    rng = random.Random(size)
    item = rng.sample(words, size)
    bench = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    rows = [
        (place, " ".join([sentence(rng, words, 20), *item[:place], "other", *item[place + 1 :], "end"]))
        for place in range(size)
    ]
    rows.append((99, " ".join([sentence(rng, words, 20), *item[: size // 2], sentence(rng, words, 20)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for limit in (decontaminate.BROADCAST_SEEDS, 1):
        found = {r["doc_id"]: r for r in decontaminate.overlaps(docs, bench, limit=limit).collect()}
        assert set(found) == set(range(size))
        assert all(r["n_words"] >= min(13, size) and 5 * r["n_equal"] >= 4 * r["n_words"] for r in found.values())
    assert [r["doc_id"] for r in decontaminate.keep_clean(docs, bench).collect()] == [99]


def brute_overlaps(rows, items):
    """Every diagonal on which a mask, or a whole short item, is equal word for word."""
    def words_of(text):
        return [w.lower() for w in re.findall("[A-Za-z0-9]+", text or "")]

    found = {}
    for doc, text in rows:
        words = words_of(text)
        for item_id, item in items:
            item = words_of(item)
            if doc is None or item_id is None or not item or not words:
                continue
            masks = decontaminate.MASKS if len(item) >= 10 else ("1" * len(item),)
            best = None
            for diagonal in range(-len(item) + 1, len(words)):
                low, high = max(0, -diagonal), min(len(item), len(words) - diagonal)
                same = [words[k + diagonal] == item[k] for k in range(low, high)]
                if not any(
                    all(same[k + j] for j, read in enumerate(mask) if read == "1")
                    for mask in masks
                    for k in range(len(same) - len(mask) + 1)
                ):
                    continue
                overlap = decontaminate.best_overlap(np.array(same), min(13, len(item)))
                if overlap:
                    begin, length, equal = overlap
                    new = (equal, -(low + begin + diagonal), -(low + begin), length)
                    best = max(best or new, new)
            if best:
                found[doc, item_id] = max(found.get((doc, item_id), best), best)
    return {(*key, -b[1], -b[2], b[3], b[0]) for key, b in found.items()}


def test_whole_rows_against_brute_force(spark, words):
    rng = random.Random(21)
    few = words[:12]  # so that short items and parts of long ones occur by themselves
    items = [(n, sentence(rng, few, n)) for n in (1, 2, 3, 5, 7, 9)]
    items += [(20 + n, sentence(rng, words, n)) for n in (4, 8, 9, 10, 11, 13, 18, 30)]
    items += [(60, sentence(rng, few, 14)), (61, None), (62, " ,"), (None, "x"), (63, items[0][1])]
    rows = [(i, sentence(rng, few, rng.randint(1, 40))) for i in range(12)]
    for i, (_, item) in enumerate(items[:15]):
        changed = item.split()
        if len(changed) > 12:
            changed[rng.randrange(len(changed))] = "other"
        rows.append((100 + i, f"{sentence(rng, words, 15)} {' '.join(changed).upper()}, {sentence(rng, words, 4)}"))
    rows += [(200, None), (201, ""), (None, items[0][1]), (100, rows[12][1])]
    docs = spark.createDataFrame([(*r, 3, 4) for r in rows], "doc_id long, text string, item_id int, code int")
    bench = spark.createDataFrame([(*r, "c") for r in items], "item_id long, text string, place string")
    expected = brute_overlaps(rows, items)
    assert {i for _, i, *_ in expected} >= {n for n, _ in items[:14]}
    for limit in (decontaminate.BROADCAST_SEEDS, 1):
        found = decontaminate.overlaps(docs, bench, limit=limit)
        rows_found = [tuple(r) for r in found.collect()]
        assert len(rows_found) == len(set(rows_found)) and set(rows_found) == expected
        kept = {r["doc_id"] for r in decontaminate.keep_clean(docs, bench, limit=limit).collect()}
        dirty = {d for d, *_ in expected}
        assert kept - {None} == {i for i, _ in rows if i is not None} - dirty


def test_a_very_long_text_with_a_common_short_item(spark):
    docs = spark.createDataFrame([(1, "the cat " * 100_000)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "the"), (2, "cat the"), (3, "cat cat")], "item_id long, text string")
    for limit in (decontaminate.BROADCAST_SEEDS, 1):
        found = {tuple(r) for r in decontaminate.overlaps(docs, bench, limit=limit).collect()}
        assert found == {(1, 1, 0, 0, 1, 1), (1, 2, 1, 0, 2, 2)}


def test_both_ways_keep_the_same_rows(spark, words):
    rng = random.Random(4)
    item = sentence(rng, words, 20)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(None, item), (1, item), (1, "clean one"), (2, item), (3, None), (None, "clean"), (4, ""), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for limit in (decontaminate.BROADCAST_SEEDS, 1):
        kept = decontaminate.keep_clean(docs, bench, limit=limit)
        assert kept.columns == docs.columns
        assert Counter(map(tuple, kept.collect())) == Counter(r for r in rows if r[1] != item)


def test_overlap_equals_brute_force():
    rng = np.random.default_rng(6)
    for _ in range(400):
        same = rng.random(rng.integers(1, 30)) < 0.8
        stretches = [
            (int(np.where(same[i:j], 1, -4).sum()), j - i)
            for i in range(len(same)) for j in range(i + 8, len(same) + 1)
        ]
        found, best = decontaminate.best_overlap(same, 8), max(stretches, default=(-1, 0))
        assert (found is not None) == (best[0] >= 0)
        if found:
            begin, length, equal = found
            assert length >= 8 and equal == same[begin : begin + length].sum()
            assert equal - 4 * (length - equal) == best[0]


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 1, 4])
    emissions, steps = rng.normal(size=(8, 2)), rng.normal(size=(2, 2))
    got = languages.marginal_sums(emissions.astype(np.float32), steps, lengths)
    at = 0
    for row, size in zip(got, lengths):
        total = np.zeros(2)
        weight = 0.0
        for path in np.ndindex(*([2] * size)):
            score = sum(emissions[at + t, s] for t, s in enumerate(path))
            score += sum(steps[a, b] for a, b in zip(path, path[1:]))
            weight += np.exp(score)
            total += np.exp(score) * np.bincount(path, minlength=2)
        assert np.allclose(row, total / weight, atol=1e-4)
        at += size


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r["doc_id"]: r for r in languages.identify(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i in found if found[i]["held_out"]} == set(held)
    assert sum(found[i]["lang_pred"] == truth[i] for i in held) >= 0.97 * len(held)


def test_language_edges(spark, docs):
    rows = languages.identify(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    found = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert [found[i] for i in (0, 1, 2, 6)] == ["und"] * 4 and found[5] == "en"
    assert {r["lang_pred"] for r in languages.identify(docs.withColumn("lang", pii.F.lit(None).cast("string"))).collect()} == {"und"}
    assert languages.identify(docs.limit(0)).collect() == []
    assert languages.keep_identified(docs).columns == docs.columns


def brute_secrets(text):
    out = []
    for k, (name, _, pattern, group, least) in enumerate(blob_ledger.RULES[:3]):
        plain = r"[0-9a-f]+" if name == "hex" else pattern
        for m in re.finditer(plain, text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(), k, m.end(), name))
    return ",".join(f"{n}:{a}:{b}" for a, _, b, n in sorted(out))


def test_ledger_moves_only_texts_that_may_be_pending(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "ledger")
    texts = [f"text {i} token=abcdefgh{i}" for i in range(300)] + ["text 0 token=abcdefgh0"] * 200
    rows = [(i, t, b"x", "r", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, blob binary, rule string, version int")
    first = blob_ledger.report(docs, path).collect()
    moved = []
    real = blob_ledger._pending_once

    def counting(pending):
        def run(batches):
            for batch in real(pending)(batches):
                yield batch

        moved.append(pending.value)
        return run

    monkeypatch.setattr(blob_ledger, "_pending_once", counting)
    again = blob_ledger.report(docs, path).collect()
    assert not moved  # nothing is pending, so no text is read to be moved
    assert sorted(map(str, again)) == sorted(map(str, first))
    more = docs.union(spark.createDataFrame([(900, "password: 12345678", b"", "", 0)], docs.schema))
    found = {r["doc_id"]: r["spans"] for r in blob_ledger.report(more, path).collect()}
    assert found[900] == "assign:0:18"
    named = more.select(blob_ledger.blob_of(F.col("text")).alias("blob"), "text")
    named = named.withColumn("code", blob_ledger._code(F.col("blob")))
    (pending,) = moved
    admitted = [pending.may_have(np.array([r["code"]]))[0] for r in named.collect()]
    assert admitted[-1] and sum(admitted) < 5


def test_ledger_edge_rows(spark, tmp_path):
    schema = "doc_id long, text string, spans string, s long, pair int"
    empty = spark.createDataFrame([], schema)
    assert blob_ledger.report(empty, str(tmp_path / "none")).collect() == []
    assert blob_ledger.read_ledger(spark, str(tmp_path / "none")).count() == 0
    long = "x " * 2_000_000 + "token=abcdefghij" + " é" * 1_000_000 + "f" * 500_000
    docs = spark.createDataFrame([(1, long, "c", 2, 3), (2, None, "c", 2, 3), (None, "", "c", 2, 3)], schema)
    found = {r["doc_id"]: r for r in blob_ledger.report(docs, str(tmp_path / "ledger")).collect()}
    assert found[1]["spans"] == "assign:4000000:4000016,hex:6000016:6500016"
    assert found[2]["spans"] == found[None]["spans"] == "" and found[2]["blob"] == found[None]["blob"]


def test_ledger_scans_only_what_is_new(spark, tmp_path):
    secret = 'é token = "0123456789abcdef0123456789abcdef01" Api-key PASSWORD: short, ' + "AKIA" + "A1" * 8
    rows = [(1, secret), (2, secret), (3, None), (4, ""), (None, "api_key=abcdefgh1"), (1, "ſecret=abcdefghij")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = str(tmp_path / "ledger")
    found = blob_ledger.report(docs, path).collect()
    assert len(found) == len(rows)
    want = Counter((i, hashlib.sha256(brute_secrets(t or "").encode()).hexdigest()) for i, t in rows)
    assert Counter((r["doc_id"], r["base_sha256"]) for r in found) == want
    scanned = blob_ledger.read_ledger(spark, path).count()
    assert scanned == 4 * len(blob_ledger.RULES)
    more = docs.union(spark.createDataFrame([(9, "new text")], docs.schema))
    blob_ledger.report(more, path).collect()
    assert blob_ledger.read_ledger(spark, path).count() == scanned + len(blob_ledger.RULES)
    newer = tuple((n, v + (n == "access"), *rest) for n, v, *rest in blob_ledger.RULES)
    again = blob_ledger.report(more, path, newer).collect()
    assert blob_ledger.read_ledger(spark, path).count() == scanned + len(blob_ledger.RULES) + 5
    assert {(r["n_assign"], r["n_access"], r["n_hex"]) for r in again if r["doc_id"] == 2} == {(1, 1, 1)}


def test_transcripts_of_all_styles(spark):
    texts = {
        1: "User: hello there?\nAssistant: hi\nmore\nUser: bye",
        2: "### System\nbe kind\n### User\nwhat is it?\n### Assistant\nit is this",
        3: "<|user|>a\n<|assistant|>b",
        4: None, 5: "",
    }
    raw = spark.createDataFrame([(k, 0, t) for k, t in texts.items()], "conv_id long, part long, text string")
    model = transcripts.Chances(np.zeros(transcripts.STATES * (transcripts.WEIGHT + transcripts.STATES + 1)))
    found = defaultdict(list)
    for r in sorted(transcripts.parse(raw, model).collect(), key=lambda r: (r["conv_id"], r["piece"])):
        found[r["conv_id"]].append((r["role"], r["text"]))
    assert found[1] == [("user", "hello there?"), ("assistant", "hi\nmore"), ("user", "bye")]
    assert found[2] == [("system", "be kind"), ("user", "what is it?"), ("assistant", "it is this")]
    assert found[3] == [("user", "a"), ("assistant", "b")]
    assert [t for _, t in found[4] + found[5]] == ["", ""]
    assert transcripts.parse(raw.limit(0), model).collect() == []


def test_blocks_give_the_path_of_the_whole(spark, monkeypatch):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    raw = transcripts.marked(rows)
    model = transcripts.learned(raw)

    def turns():
        found = transcripts.parse(raw.drop("role"), model).collect()
        found.sort(key=lambda r: (r["conv_id"], r["block"], r["piece"]))
        lines = defaultdict(list)
        for r in found:
            lines[r["conv_id"]] += [(r["role"], i == 0 and not r["continues"]) for i in range(r["n_lines"])]
        return lines

    whole = turns()
    monkeypatch.setattr(transcripts, "PART_BLOCK", 1)
    assert turns() == whole


def best_path(model, scores):
    """Viterbi's path, step by step over the whole."""
    best, back = model.start + scores[0], []
    for line in scores[1:]:
        through = best[:, None] + model.step
        back.append(through.argmax(axis=0))
        best = through.max(axis=0) + line
    states = [int(best.argmax())]
    for row in back[::-1]:
        states.append(int(row[states[-1]]))
    return states[::-1]


def total(model, scores, states):
    steps = sum(model.step[a, b] for a, b in zip(states, states[1:]))
    return model.start[states[0]] + steps + sum(row[s] for row, s in zip(scores, states))


def test_path_equals_enumeration():
    rng = np.random.default_rng(12)
    counts = rng.integers(1, 50, transcripts.STATES * (transcripts.WEIGHT + transcripts.STATES + 1))
    model = transcripts.Chances(counts.astype(float))
    for size in (1, 2, 3, 4):
        scores = rng.normal(size=(size, transcripts.STATES))
        with np.errstate(invalid="ignore"):
            def score(states):
                total = model.start[states[0]] + scores[0, states[0]]
                for t in range(1, size):
                    total += model.step[states[t - 1], states[t]] + scores[t, states[t]]
                return total

            best = max(np.ndindex(*([transcripts.STATES] * size)), key=score)
        assert list(best) == best_path(model, scores)
        assert list(best) == transcripts.path(model, scores, model.start, None).tolist()


@pytest.mark.parametrize("fan, count", [(64, 4500), (3, 100)])
def test_a_conversation_of_thousands_of_blocks(spark, monkeypatch, fan, count):
    monkeypatch.setattr(transcripts, "PART_BLOCK", 1)
    monkeypatch.setattr(transcripts, "FAN", fan)
    rng = random.Random(13)
    said = ["fine", "is it so?", "", "- a point", "User: and you?", "Assistant: well", "a " * 90]
    rows = [(None, i, rng.choice(said)) for i in range(count)]
    rows += [(7, i, rng.choice(said[:4])) for i in range(fan + 1)] + [(8, 0, "User: one"), (9, 0, None)]
    shape = "conv_id long, part long, text string, span string, before int, place int"
    raw = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], shape).repartition(4)
    rng = np.random.default_rng(14)
    counts = rng.integers(1, 50, transcripts.STATES * (transcripts.WEIGHT + transcripts.STATES + 1))
    model = transcripts.Chances(counts.astype(float))

    def bounded(real):
        def run(frame):
            if len(frame) > fan:
                raise ValueError(f"a group of {len(frame)} rows")
            return real(frame)

        return run

    for name in ("_combined", "_passed_down"):
        monkeypatch.setattr(transcripts, name, bounded(getattr(transcripts, name)))
    found = defaultdict(list)
    for r in sorted(transcripts.parse(raw, model).collect(), key=lambda r: (r["block"], r["piece"])):
        found[r["conv_id"]] += [(r["role"], i == 0 and not r["continues"]) for i in range(r["n_lines"])]
    assert set(found) == {None, 7, 8, 9}
    for conv in found:
        texts = [t or "" for c, _, t in rows if c == conv]
        marked = any(transcripts.marker_of(t)[0] for t in texts)
        scores = model.scores(transcripts.observed(texts, True, marked, False))
        # Several paths can be the best, so their sums are compared.
        own = [transcripts.ROLES.index(r) + (0 if begins else len(transcripts.ROLES)) for r, begins in found[conv]]
        assert len(own) == len(texts)
        assert total(model, scores, own) == pytest.approx(total(model, scores, best_path(model, scores)), rel=1e-12)


def test_blocks_are_bounded_whatever_the_numbers(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(None, rng.choice([0, 1, 2, 7, None]), f"User: q{rng.randrange(500)}?\nAssistant: a", "user") for _ in range(1500)]
    rows += [(1, None, f"line {i}", "user") for i in range(150)] + [(2, 0, "User: same", None)] * 150
    rows += [(3, i, f"Human: {i}", "user") for i in range(150)]
    raw = spark.createDataFrame(rows, "conv_id long, part long, text string, role string").repartition(5)
    blocks = transcripts._blocks(raw, "role").collect()
    assert max(len(r["parts"]) for r in blocks) == transcripts.PART_BLOCK
    key = lambda p: (p[0] is not None, p[0] or 0, p[1])
    for conv in (None, 1, 2, 3):
        own = sorted((r for r in blocks if r["conv_id"] == conv), key=lambda r: r["block"])
        assert [r["block"] for r in own] == list(range(len(own)))
        assert all(len(r["parts"]) == transcripts.PART_BLOCK for r in own[:-1])
        parts = [(p["part"], p["text"]) for r in own for p in r["parts"]]
        assert parts == sorted([(r[1], r[2]) for r in rows if r[0] == conv], key=key)
    model = transcripts.learned(raw)

    def lines():
        found = defaultdict(list)
        for r in sorted(transcripts.parse(raw, model).collect(), key=lambda r: (r["block"], r["piece"])):
            found[r["conv_id"]] += [(r["role"], i == 0 and not r["continues"]) for i in range(r["n_lines"])]
        return found

    bounded = lines()
    monkeypatch.setattr(transcripts, "PART_BLOCK", 10_000)
    assert lines() == bounded


def naive_likelihood(text, weights, known):
    """Word by word from the formulas."""
    embed, bias, out, out_bias = masked_lm._split(weights.astype(float), known.size)
    numbers = known.numbers(text).tolist()
    total = 0.0
    for t, own in enumerate(numbers):
        hidden = bias.copy()
        for k, side in enumerate((-2, -1, 1, 2)):
            inside = 0 <= t + side < len(numbers)
            hidden += embed[k, numbers[t + side] if inside else known.boundary]
        scores = np.tanh(hidden) @ out + out_bias
        chance = np.exp(scores - scores.max())
        total += np.log(chance[known.classes[own]] / chance.sum()) + known.shares[own]
        if own >= len(known.codes):
            total += known.tail_shares(text[t : t + 1])[0][0]
    return total


@pytest.fixture(scope="module")
def small_lm(spark):
    rng = random.Random(31)
    left, right = ["der", "die", "das"], ["the", "a", "of"]
    texts = []
    for i in range(300):
        small, nouns = (left, "abcdef") if i % 2 else (right, "uvwxyz")
        texts.append(" ".join(f"{rng.choice(small)} {rng.choice(nouns)}{rng.randrange(9)}" for _ in range(20)))
    docs = spark.createDataFrame([(t,) for t in [*texts, None, ""]], "text string")
    return texts, docs, masked_lm.vocabulary(docs)


def test_likelihood_equals_the_formulas(small_lm):
    texts, _, known = small_lm
    rng = np.random.default_rng(32)
    weights = rng.normal(size=len(masked_lm.start_weights(known.size))).astype(np.float32)
    coded = WordCodes().of(pa.array([*texts[:6], "", "der unseen a1 the", "der"]))
    got = masked_lm.log_likelihoods(coded, weights, known)
    want = [naive_likelihood(text, weights, known) for text in coded]
    assert np.allclose(got, want, rtol=1e-4)


def test_chances_of_all_words_add_up_to_one(small_lm, monkeypatch):
    texts, docs, _ = small_lm
    monkeypatch.setattr(masked_lm, "EMBEDDED_LEAST", 40)
    known = masked_lm.vocabulary(docs)
    assert len(known.codes) == 40 and len(known.table) > 20
    for number in range(masked_lm.CLASSES - 1):
        own = known.shares[: len(known.codes)][known.classes[: len(known.codes)] == number]
        assert not len(own) or np.exp(own).sum() == pytest.approx(1)
    unseen = masked_lm.SMOOTHING / known.others
    assert np.exp(known.table_shares).sum() + unseen == pytest.approx(1)
    weights = masked_lm.start_weights(known.size)
    parts = masked_lm._split(weights, known.size)
    hidden = masked_lm._hidden(parts, [np.array([3, known.boundary])] * 4)
    assert np.allclose(np.exp(masked_lm._log_classes(parts, hidden)).sum(axis=1), 1, atol=1e-5)


def test_gradient_equals_finite_differences(small_lm, monkeypatch):
    texts, _, known = small_lm
    line, places = masked_lm.contexts(WordCodes().of(pa.array(texts[:3])), known)
    rng = np.random.default_rng(33)
    weights = rng.normal(0, 0.5, len(masked_lm.start_weights(known.size)))

    def loss(values):
        parts = masked_lm._split(values, known.size)
        hidden = masked_lm._hidden(parts, [line[places + side] for side in masked_lm._SIDES])
        logs = masked_lm._log_classes(parts, hidden)
        return -logs[np.arange(len(places)), known.classes[line[places]]].mean()

    slopes = np.zeros_like(weights)
    slope_parts = masked_lm._split(slopes, known.size)

    def record(self, part, where, slope):
        slope_parts[part][where] += slope

    monkeypatch.setattr(masked_lm.Trainer, "_move", record)
    masked_lm.Trainer(weights, known).step(line, places)
    used = np.flatnonzero(np.abs(slopes) > 1e-6)
    for at in [*rng.choice(used, 60, replace=False), *range(len(weights) - 60, len(weights))]:
        ahead, behind = weights.copy(), weights.copy()
        ahead[at] += 1e-4
        behind[at] -= 1e-4
        assert slopes[at] == pytest.approx((loss(ahead) - loss(behind)) / 2e-4, abs=2e-5)


def test_classes_come_from_contexts(small_lm):
    _, _, known = small_lm
    rng = np.random.default_rng(34)
    profile = np.repeat(rng.integers(0, 200, (3, 2 * masked_lm.KINDS)), 30, axis=0)
    profile = rng.poisson(profile)
    classes = masked_lm.learned_classes(profile, np.repeat([50.0, 7.0, 1.0], 30))
    kinds = [set(classes[i : i + 30]) for i in (0, 30, 60)]
    assert not (kinds[0] & kinds[1] or kinds[1] & kinds[2] or kinds[0] & kinds[2])
    assert masked_lm.learned_classes(profile[:0], np.empty(0)).shape == (0,)
    german, english = (
        {int(known.classes[n]) for n in known.numbers(WordCodes().of(pa.array([words]))[0])}
        for words in ("der die das", "the a of")
    )
    assert not german & english


def test_every_place_is_learned_once(small_lm):
    texts, docs, known = small_lm
    steps = []

    class Counting(masked_lm.Trainer):
        def step(self, line, places):
            steps.extend(places.tolist())

    batch = pa.record_batch([pa.array(texts)], ["text"])

    class Held:
        def __init__(self, value):
            self.value = value

    start, real = masked_lm.start_weights(known.size), masked_lm.Trainer
    masked_lm.Trainer = Counting
    try:
        for round_ in range(masked_lm.ROUNDS):
            run = masked_lm._trained(Held(start), Held(known), round_)
            try:
                list(run(iter([batch])))
            except AttributeError:  # no task to number what is sent back
                pass
    finally:
        masked_lm.Trainer = real
    assert len(steps) == len(set(steps)) == sum(len(t.split()) for t in texts)


def test_contexts_beat_frequencies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    learned_from = docs.filter(~held)
    weights, shared = masked_lm.train(learned_from, masked_lm.vocabulary(learned_from))
    known = shared.value
    coded = WordCodes().of(pa.array([r["text"] for r in docs.filter(held).select("text").collect()]))
    sums, rest = masked_lm._likelihoods(coded, weights.value, known)
    unseen = np.log(masked_lm.SMOOTHING / known.others)
    mean = (sums.sum() + sum(map(len, rest)) * unseen) / sum(map(len, coded))
    counts = {r["code"]: r["n"] for r in masked_lm.word_counts(learned_from).collect()}
    tokens = sum(counts.values()) + masked_lm.SMOOTHING * (len(counts) + 1)
    codes = np.concatenate(coded).view(np.int64).tolist()
    unigram = np.mean([np.log((counts.get(c, 0) + masked_lm.SMOOTHING) / tokens) for c in codes])
    assert mean > unigram + 0.3


def test_masked_lm_learns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = masked_lm.vocabulary(docs)
    texts = WordCodes().of(pa.array([r["text"] for r in docs.select("text").collect()]))
    before = masked_lm.log_likelihoods(texts, masked_lm.start_weights(known.size), known).sum()
    weights, shared = masked_lm.train(docs, known)
    after = masked_lm.log_likelihoods(texts, weights.value, shared.value).sum()
    assert after > before


def test_masked_lm_edges(spark, docs):
    rows = masked_lm.score(docs).collect()
    assert len(rows) == docs.count()
    empty = [r for r in rows if r["doc_id"] in (0, 1, 2)]
    assert all(r["n_tokens"] == 0 and r["log_likelihood"] == 0 and r["mean_log_likelihood"] is None for r in empty)
    assert all(np.isfinite(r["log_likelihood"]) for r in rows)
    assert masked_lm.score(docs.limit(0)).collect() == []


def test_rare_words_have_their_own_shares(spark, monkeypatch):
    common = " ".join(f"w{i}" for i in range(4096))
    texts = [common] * 100 + ["often"] * 50 + ["junk", "often junk", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).cache()
    whole = {r["doc_id"]: r for r in masked_lm.score(docs).collect()}
    gap = whole[100]["log_likelihood"] - whole[150]["log_likelihood"]
    assert gap == pytest.approx(np.log(51.5 / 2.5))
    # The same where counts meet their words by the join.
    monkeypatch.setattr(masked_lm, "TABLE_WORDS", 0)
    joined = {r["doc_id"]: r for r in masked_lm.score(docs).collect()}
    assert len(joined) == len(texts) and joined[152]["mean_log_likelihood"] is None
    for key, r in joined.items():
        assert r["log_likelihood"] == pytest.approx(whole[key]["log_likelihood"], rel=1e-4)
        assert r["n_tokens"] == whole[key]["n_tokens"]


def test_embedded_words_grow_with_the_corpus(spark):
    text = " ".join(f"w{i}" for i in range(6000))
    docs = spark.createDataFrame([(text,)], "text string")
    sizes = [len(masked_lm.vocabulary(docs.withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(n))))).codes) for n in (2, 1100)]
    assert sizes == [4096, 6000]


def test_window_gradients():
    rng = np.random.default_rng(4)
    known = masked_lm.Vocabulary(np.arange(5, dtype=np.uint64), np.array([0, 1, 2, 0, 1] + [3] * 257), np.zeros(262))
    line, places = masked_lm.contexts([rng.integers(0, 5, 40).astype(np.uint64)], known)
    trainer = masked_lm.Trainer(masked_lm.start_weights(known.size), known)
    texts = [known.codes[line[places]]]
    first = masked_lm.log_likelihoods(texts, trainer.weights, known)[0]
    for _ in range(30):
        trainer.step(line, places)
    assert masked_lm.log_likelihoods(texts, trainer.weights, known)[0] > first + 10


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(60, 64))
    near = [base[i % 20] + rng.normal(size=64) * 0.05 * np.linalg.norm(base[i % 20]) for i in range(200)]
    vectors = [v.astype(np.float32).tolist() for v in [*base, *near]]
    vectors += [vectors[0]] * 30 + [[2 * x for x in vectors[1]]]
    odd = [None, [], [0.0] * 64, [float("nan")] * 64, [None] * 64, [1.0, 2.0], [1.0, 2.1]]
    rows = [(i, v, 0, 5) for i, v in enumerate(vectors + odd)] + [(None, vectors[2], 0, 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n_links int")
    found = {r["vec_id"]: r for r in embedding_lsh.near_duplicates(frame).collect()}
    unit = np.array(vectors, np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    same = unit @ unit.T >= 0.9
    counts = same.sum(axis=1) - 1
    got = np.array([found[i]["n_links"] for i in range(len(vectors))])
    assert (got <= counts).all() and got.sum() >= 0.99 * counts.sum()
    expected = brute_components(range(len(vectors)), np.argwhere(same).tolist())
    assert np.mean([found[i]["component_id"] == expected[i] for i in expected]) > 0.98
    at = len(vectors)
    assert [found[at + k]["n_links"] for k in range(7)] == [0, 0, 0, 0, 0, 1, 1]
    assert found[None]["component_id"] is None and not found[None]["kept"]
    assert embedding_lsh.near_duplicates(frame.limit(0)).collect() == []


def test_warc_round_trip(spark, tmp_path):
    big = "<p>é" + "word " * 400
    rows = [(1, "http://a.example/x y\r\nX: 1", big, 1), (2, None, big, 1), (3, "u", None, 1), (4, "u", "", 1),
            (5, "u", "small", 1), (6, "u", "small", 1), (7, "u", big + "!", 1), (2, None, big, 1), (None, "u", big, 1)]
    rows += [(100 + i, f"http://b.example/{i}", f"<html>{'row ' * 50}{i}</html>", 1) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, refers_to int")
    folder = f"file://{tmp_path}/warc"
    manifest = warc.write_archives(pages, folder)
    back = warc.read_archives(manifest, folder).collect()
    assert len(back) == len(rows) == sum(r["records"] for r in manifest.collect())
    by_id = defaultdict(list)
    for r in back:
        by_id[r["page_id"]].append(r)
    for page, _, html, _ in rows:
        for r in by_id[page]:
            payload = (html or "").encode()
            assert r["payload_bytes"] == len(payload)
            assert r["payload_digest"] == hashlib.sha1(payload).hexdigest()
            assert r["record_type"] == "revisit" or r["payload"] == payload
    assert {k: [(r["record_type"], r["refers_to"]) for r in by_id[k]] for k in (1, 2, 6, 7, None)} == {
        1: [("revisit", 2)], 2: [("response", None)] * 2, 6: [("response", None)], 7: [("response", None)],
        None: [("revisit", 2)],
    }
    assert by_id[1][0]["url"] == "http://a.example/x%20y%0D%0AX:%201"
    assert warc.round_trip(pages.limit(0)).collect() == []


@pytest.mark.parametrize("name", sorted(llm.ORACLE_SQL))
def test_query_with_sql(spark, name):
    assert_same(llm.QUERIES[name](spark, SF_DIR), llm.ORACLE_SQL[name], SF_DIR)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    _, component = brute_jaccard(rows)
    items = [" ".join(r["text"].split()) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = {i for i, t in rows if component[i] == i and not any(b in " ".join(t.split()) for b in items)}
    kept = {r["doc_id"] for r in corpus_pipeline.run(spark, SF_DIR).select("doc_id").distinct().collect()}
    assert kept <= {i for i in component if component[i] == i}
    assert len(clean ^ kept) <= 0.02 * len(clean)


def test_pipeline_stages_take_odd_rows(spark, docs, tmp_path):
    spark.createDataFrame([(1, "a b")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for some in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            some_out = stage(spark, some, str(tmp_path))
            some_out.collect()
            if stage is not corpus_pipeline.pack:
                assert some_out.columns == docs.columns
