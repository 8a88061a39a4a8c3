"""Personal data, tokens, leaks and abuse: cases, round trips, brute force, held-out accuracy."""

import os
import random

import numpy as np
import pytest

from rolodar.llm import abuse, leaks, personal, tokens
from rolodar.llm.plaintext import words


def personal_corpus():
    """Notes in which contexts stand beside proven and unproven forms, and what each holds."""
    rng = random.Random(5)
    givens, families = ["Guillermo", "Konstantin", "Susan", "Zoë"], ["Rasfieau", "Elmpradale", "Ray", "Juleci"]
    forms = {
        "phone": ["+1 914 555 {:04}", "914.555.{:04}", "914 / 555 / {:04}"], "email": ["a{}@helm.example", "a{} at helm dot example"],
        "id_number": ["936-77-{:04}", "93677{:04}", "S872-9305-{:04}"], "street_address": ["{} Ridge Avenue", "{} Ridge Ave", "PO Box {}", "Box {}"],
    }
    before = {"phone": ["Please call", "reachable on"], "email": ["new mail is", "write to"], "id_number": ["passport no.", "tax id"], "street_address": ["moved to", "ship to"]}
    notes, truth = [], []
    for i in range(400):
        kind = sorted(forms)[i % 4]
        value = rng.choice(forms[kind]).format(1000 + i)
        head = rng.choice(before[kind])
        who = f"{rng.choice(givens)} {rng.choice(families)}" if i % 3 else f"New{'abcdefgh'[i % 8]}x Unheard{'abcdefgh'[i % 7]}"
        text = f"Spoke with {who} about terms. {head} {value} soon. Order {100000 + i:06}-{20000 + i} shipped."
        if i % 5 == 0:
            text += " Works with Granara Robotics now. will sign later"
        truth += [(i, "person_name", who), (i, kind, value)]
        notes.append(text)
    return notes + ["", None, "z " * 30000, "Clear View demo"], truth


def test_personal(spark):
    notes, truth = personal_corpus()
    df = spark.createDataFrame([(i, n, "k") for i, n in enumerate(notes)], "rec_id long, notes string, kind string").repartition(3)
    people = spark.createDataFrame([("Guillermo", "", "Rasfieau"), ("Konstantin", "Will", "Elmpradale"), ("Susan", None, "Ray"), ("Zoë", "", "Juleci")], "first_name string, nickname string, last_name string")

    def found(rounds):
        items = personal.extract(df, "rec_id", "notes", people, ["first_name", "nickname"], "last_name", rounds=rounds).cache()
        return items, {(r["rec_id"], r["kind"], notes[r["rec_id"]][r["start_at"] - 1 :][: r["size"]]) for r in items.collect()}

    _, seeds = found(0)
    items, got = found(3)
    # Seeds alone prove the strict forms; contexts and layouts find the others, and names that no list holds.
    assert seeds < set(truth) and len(seeds) < 0.7 * len(truth)
    assert got == set(truth)
    red = {r["rec_id"]: r["notes"] for r in personal.redact(df, "rec_id", "notes", items).collect()}
    assert red[1].startswith("Spoke with [NAME] about terms.") and "[ID]" in red[1] and "Order 100001-20001" in red[1] and red[401] is None and red[403] == notes[403]
    assert personal.extract(df.limit(0), "rec_id", "notes", people, ["first_name"], "last_name").count() == 0


def test_bloom_has_every_word(spark):
    words_ = [f"name{i}" for i in range(5000)] + ["zoë", "漢字"]
    filter_ = personal.bloom(spark.createDataFrame([(w,) for w in words_], "given string"), "given", frozenset(["bob"]))
    assert all(w in filter_ for w in [*words_, "bob"]) and sum(f"other{i}" in filter_ for i in range(5000)) < 50


TEXTS = ["", "Hello world", "aaaaaaaaa", "<|endoftext|> x", "   ", "\n\n  x", "😀 é́ 漢字​", "I'LL we'll they've", "a" * 5001, "----====----", "x1y22z333", None]


@pytest.mark.skipif(not os.path.exists(tokens.DEFAULT_VOCABULARY), reason="no vocabulary file")
def test_tokens_against_library_and_round_trip(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.DEFAULT_VOCABULARY)
    t.encode_special_tokens = True
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("ab cdé \n'sre12漢") for _ in range(200)) for _ in range(60)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: list(r["ids"]) for r in tokens.encode(df, "doc_id", "text").collect()}
    assert got == {i: t.encode(x or "", add_special_tokens=False).ids for i, x in enumerate(texts)}
    back = {i: b for b, i in zip(tokens.byte_letters().values(), tokens.Merges.load(tokens.DEFAULT_VOCABULARY).byte_ids)}
    assert len(back) == 256 and all(t.decode(got[i], skip_special_tokens=False) == x for i, x in enumerate(texts) if x and "​" not in x)
    assert tokens.encode(df.limit(0), "doc_id", "text").count() == 0


def brute_bpe(word, m):
    rank = {(int(a), int(b)): (i, int(c)) for i, (a, b, c) in enumerate(zip(m.left, m.right, m.result))}
    s = [int(m.byte_ids[b]) for b in word]
    while len(s) > 1:
        best = min((rank.get(p, (10**9, 0))[0], i) for i, p in enumerate(zip(s, s[1:])))
        if best[0] == 10**9:
            break
        i = best[1]
        s[i : i + 2] = [rank[(s[i], s[i + 1])][1]]
    return s


def test_pair_index_against_brute_force():
    vocab = {x: i for i, x in enumerate(tokens.byte_letters())}
    merges = [("a", "a"), ("aa", "a"), ("b", "a"), ("aa", "aa"), ("ba", "aa"), ("c", "ba")]
    for a, b in merges:
        vocab[a + b] = len(vocab)
    m = tokens.Merges(vocab, [list(x) for x in merges])
    rng = random.Random(1)
    ws = ["".join(rng.choice("aabc") for _ in range(rng.randrange(0, 14))).encode() for _ in range(300)]
    ids, off = tokens.encode_words(ws, m)
    assert [ids[off[i] : off[i + 1]].tolist() for i in range(len(ws))] == [brute_bpe(w, m) for w in ws]


def passage(rng, n):
    return [f"w{rng.randrange(4000)}" for _ in range(n)]


def test_leaks(spark):
    rng = random.Random(2)
    items = [passage(rng, 60) for _ in range(4)]
    edited = list(items[1][10:50])
    for i in range(5, 40, 9):
        edited[i] = "changed"
    del edited[20]
    cyr = " ".join(items[2][:30]).replace("w1", "w​1").upper()
    shuffled = items[0][:]
    rng.shuffle(shuffled)
    docs = [
        "intro " + " ".join(items[0]) + " outro", "x y " + ",\n".join(edited), cyr, " ".join(shuffled), " ".join(items[3][:12]), "", None,
        " ".join(items[0][:18]) + " zz " + " ".join(items[3][30:48]), "long " * 40000,
    ]
    df = spark.createDataFrame([(i, d, "c") for i, d in enumerate(docs)], "doc_id long, text string, item_id string").drop("item_id")
    tests = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(9, None), (10, "")], "item_id long, text string")
    found = leaks.leaks(df, "doc_id", "text", tests, "item_id", "text").cache()
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(0, 0), (1, 1), (2, 2), (7, 0), (7, 3)}
    assert {r["doc_id"] for r in leaks.without_leaks(df, "doc_id", found).collect()} == {3, 4, 5, 6, 8}
    assert leaks.leaks(df.limit(0), "doc_id", "text", tests, "item_id", "text").count() == 0


def test_leaks_in_passes_and_parts(spark, monkeypatch):
    rng = random.Random(12)
    items = [["as", "well", "as", "the", *passage(rng, 40)] for _ in range(6)]
    docs = [" ".join(passage(rng, 30) + items[i % 6][: 20 + i] + ["as well as the"] * 20) for i in range(12)] + [" ".join(["as well as the"] * 3000)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    tests = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    want = {(i, i % 6) for i in range(12)}
    assert {(r[0], r[1]) for r in leaks.leaks(df, "doc_id", "text", tests, "item_id", "text", max_items=2).collect()} == want
    monkeypatch.setattr(leaks, "MOST_HITS", 50)
    built = leaks.Items.build([(i, " ".join(t)) for i, t in enumerate(items)])
    assert {(k, i) for k, i, *_ in leaks.shard_leaks(list(range(13)), docs, built, leaks.Rule())} == want


def test_windows_hold_every_close_pair():
    rng = random.Random(1)
    for _ in range(100):
        d = np.unique([rng.randrange(200) for _ in range(30)])
        found = leaks.windows(d, 7)
        assert all(b - a <= 14 for a, b in found)
        assert all(any(a <= x and y <= b for a, b in found) for x in d for y in d if 0 <= y - x <= 7)


def test_leaks_beside_edited_stretches(spark):
    item = [f"v{i}" for i in range(95)]

    def new(n):
        return [f"new{i}" for i in range(n)]

    every = [w if i % 4 else "changed" for i, w in enumerate(item[20:80])]
    docs = [
        item[:20] + every, item[:24] + new(11) + item[35:59], item[:30] + new(14) + item[44:74],
        [w if i not in (3, 7, 11) else "changed" for i, w in enumerate(item[:18])], item[:17] + new(5), [w if i % 3 else "changed" for i, w in enumerate(item)],
    ]
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    tests = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    found = leaks.leaks(df, "doc_id", "text", tests, "item_id", "text").collect()
    assert {r["doc_id"] for r in found} == {0, 1, 2, 3}
    rule = leaks.Rule()
    assert (rule.seed, rule.min_cover) == (4, 6)


def test_suffix_array_against_sorting():
    rng = np.random.default_rng(4)
    t = rng.integers(0, 4, 300)
    sa = leaks.suffix_array(t, 64)

    def suffix(i):
        out = []
        while i < len(t) and t[i] > 0 and len(out) < 64:
            out.append(int(t[i]))
            i += 1
        return out

    keys = [suffix(i) for i in sa]
    assert keys == sorted(keys) and len(sa) == int((t > 0).sum())


def test_words_fold_disguises():
    assert words("Fuсk ｎａïve​-Café") == ["fuck", "naive", "cafe"] and words("Привет") == ["привет"] and words(None) == []
    assert abuse.passages("you st*pid i-d-i-o-t and whoooore 455h0l3")[0][2:] == ["idiot", "and", "whore", "ashole"]


def test_abuse_learns_and_holds_out(spark):
    rng = random.Random(6)
    clean = ["the list has {} rows now", "please merge the entries of {}", "the killer feature of {} is the preview", "kill the stale job {} and restart", "call {} back about the invoice"]
    rude = ["shut your mouth {} you stupid idiot", "people like {} are vermin and should rot", "i will find {} and burn it down", "go hang yourself {}"]

    def doc(bad):
        parts = [rng.choice(clean).format(f"n{rng.randrange(300)}") for _ in range(5)]
        if bad:
            parts.insert(rng.randrange(5), rng.choice(rude).format(f"n{rng.randrange(300)}"))
        return ". ".join(parts)

    data = [(doc(i % 4 == 0), int(i % 4 == 0)) for i in range(600)]
    noisy = [(t, 1 - y if rng.random() < 0.03 else y) for t, y in data[:400]]
    model = abuse.fit([t for t, _ in noisy], [y for _, y in noisy])
    right = sum((model.text(t) >= 0.5) == bool(y) for t, y in data[400:])
    assert right >= 196
    # Few labels leave a cautious model: what it finds is right.
    few = abuse.fit([t for t, _ in data[:40]], [y for _, y in data[:40]])
    found = [y for t, y in data[40:] if few.text(t) >= 0.5]
    assert sum(found) >= 0.9 * len(found) and sum(found) >= 60
    assert list(model.texts([t for t, _ in data[:50]])) == [model.text(t) for t, _ in data[:50]]
    assert model.text(None) == model.text("") == model.text(" \n ") == 0.0
    df = spark.createDataFrame([(1, data[0][0], "f"), (2, None, "f"), (3, "x " * 20000, "g")], "doc_id long, text string, source string")
    scored = abuse.score(df, "doc_id", "text", model)
    assert scored.count() == 3 and scored.where("doc_id = 1").first()["abuse"] >= 0.5
    rate = {r["source"]: r["rate"] for r in abuse.rates(df.join(scored, "doc_id"), "source").collect()}
    assert rate == {"f": 0.5, "g": 0.0}
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (2, 0), (3, 0), (3, 1)], "doc_id long, abusive int")
    assert isinstance(abuse.fit_labels(df, "doc_id", "text", labels, "doc_id", "abusive"), abuse.Model)
