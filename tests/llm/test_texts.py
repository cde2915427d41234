import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.llm import leak, mixing, private
from graphloom.llm.words import words

DOCS = "doc_id bigint, text string"


def test_words():
    assert words("Ａb­c​ d_e ½ n° 3²") == ["abc", "d", "e", "1", "2", "n", "32"]
    assert words(None) == [] and words("") == [] and words("a-B c9") == ["a", "b", "c9"]


def longest_common(a, b):
    best = 0
    for i in range(len(a)):
        for j in range(len(b)):
            k = 0
            while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                k += 1
            best = max(best, k)
    return best


def test_leaks_equal_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)]
    item_texts = [[rng.choice(vocabulary) for _ in range(rng.randrange(5, 40))] for _ in range(8)]
    docs = []
    for n in range(60):
        text = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 50))]
        for _ in range(rng.randrange(3)):
            source = rng.choice(item_texts)
            size = rng.randrange(10, 18)
            start = rng.randrange(max(1, len(source) - size + 1))
            at = rng.randrange(len(text) + 1)
            text[at:at] = source[start : start + size]
        docs.append((n, " ".join(text)))
    docs += [(100, None), (101, ""), (None, " ".join(item_texts[0])), (102, " ".join(item_texts[1] * 3000))]
    items = [(i, ", ".join(t).upper()) for i, t in enumerate(item_texts)] + [(50, None), (51, "")]
    d = spark.createDataFrame(docs, DOCS).withColumns({"item_id": F.lit(1), "exact_words": F.lit(2)})
    i = spark.createDataFrame(items, "item_id bigint, text string")
    want = {(n, k) for n, t in docs if n is not None and n < 100 for k, it in enumerate(item_texts) if longest_common((t or "").split(), it) >= 13}
    for most in (leak.MOST_BITS, 64):  # a filter that fits, and one that lets nearly all pass
        monkeypatch.setattr(leak, "MOST_BITS", most)
        got = {(r["doc_id"], r["item_id"]) for r in leak.overlaps(d, i).filter("exact_words >= 13").collect()}
        assert {g for g in got if g[0] < 100} == want
        assert ((102, 1) in got) == (len(item_texts[1]) >= 13)


def test_replaced_words_are_bridged(spark):
    item = [f"w{i}" for i in range(40)]
    text = list(item)
    text[9] = text[18] = text[30] = "other"
    d = spark.createDataFrame([(1, "x y " + " ".join(text))], DOCS)
    i = spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string")
    row = leak.overlaps(d, i).head()
    assert (row["exact_words"], row["overlap_words"], row["substitutions"]) == (11, 40, 3)
    assert leak.overlaps(d.limit(0), i).count() == 0 and leak.overlaps(d, i.limit(0)).count() == 0


def test_short_items_must_stand_whole(spark):
    d = spark.createDataFrame([(1, "so one two three four five, then"), (2, "one two three four six five"), (3, "a b c d")], DOCS)
    i = spark.createDataFrame([(7, "One two three four five"), (8, "a b c d"), (9, "one two three four five"), (9, None)], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"], r["item_words"], r["exact_words"]) for r in leak.overlaps(d, i).collect()}
    assert got == {(1, 7, 5, 5), (1, 9, 5, 5)}


def test_only_text_around_windows_is_sent_on(spark):
    item = [f"w{i}" for i in range(20)]
    text = " ".join([f"a{i}" for i in range(5000)] + item + [f"b{i}" for i in range(5000)] + item)
    table = leak.item_table(spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string"))
    seeds = leak.item_seeds(table, leak.MASKS)
    found = leak.pieces(spark.createDataFrame([(1, text), (2, "b " * 5000)], DOCS), leak.seed_filter(seeds), leak.MASKS, 33).collect()
    assert len(found) == 2 and all(len(r["words"]) < 100 for r in found)


def test_overlap_against_all_stretches():
    rng = np.random.default_rng(1)
    for _ in range(60):
        same = rng.random(25) < 0.7
        best = 0
        for a in range(25):
            for b in range(a + 1, 26):
                part = same[a:b]
                if part[0] and part[-1] and (~part).sum() <= leak.SUBSTITUTION_SHARE * len(part) + 1e-9:
                    best = max(best, b - a)
        assert leak.overlap(same)[1] == best


def mix(spark, docs, targets):
    d = spark.createDataFrame(docs, "doc_id bigint, source string, text string").withColumns({"tokens": F.lit(9), "rate": F.lit(9), "copy": F.lit(9)})
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int").withColumn("tokens", F.lit(1))
    counts = mixing.token_counts(d).cache()
    rates = mixing.rates(counts, t).cache()
    return counts, rates


def test_mixing_reaches_its_shares(spark, monkeypatch):
    docs = [(n, "Big-Source ", "some words of text here") for n in range(3000)] + [(10_000 + n, "small", "other words of a text") for n in range(600)]
    docs += [(20_000 + n, "tiny", "few words") for n in range(5)] + [(30_000, None, "x"), (30_001, "none", None), (30_002, "big_source", "")]
    counts, rates = mix(spark, docs, [("big_source", 0.5, 2), ("small", 0.45, 5), ("tiny", 0.05, 3), ("absent", 0.0, 1)])
    chosen = mixing.select(counts, rates).cache()
    got = {r["source"]: r for r in mixing.shares(chosen, rates).collect()}
    total = counts.agg(F.sum("tokens")).head()[0]
    for source, share in (("big_source", 0.5), ("small", 0.45)):
        assert abs(got[source]["selected_tokens"] / total - share) < 0.02
    assert got["tiny"]["rate"] == 3.0 and chosen.filter("source = 'tiny'").count() == 15
    assert got["absent"]["selected_tokens"] == 0
    per = chosen.groupBy("doc_id", "source").agg(F.count(F.lit(1)).alias("n"), F.max("copy").alias("c")).join(rates, "source")
    assert per.filter("n > max_repeats OR n <> c OR n < floor(rate) OR n > ceil(rate)").count() == 0
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(tuple, mixing.select(counts, rates).collect())) == sorted(map(tuple, chosen.collect()))
    assert mixing.select(counts.limit(0), rates).count() == 0


def test_a_null_cap_allows_one_copy(spark):
    counts, rates = mix(spark, [(n, "s", "some words") for n in range(10)] + [(99, "t", "more words")], [("s", 0.1, 1), ("t", 0.9, None), ("u", None, 2)])
    assert {r["source"]: r["rate"] for r in rates.collect()}["t"] == 1.0 and mixing.select(counts, rates).filter("source = 't'").count() == 1


def test_token_counts_are_the_tokenizers(spark):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(mixing.TOKENIZER)
    model.encode_special_tokens = True
    texts = ["plain text", "<|endoftext|>", "日本語 und Größe", "", None, "long " * 200_000]
    counts, _ = mix(spark, [(n, "s", t) for n, t in enumerate(texts)], [("s", 1.0, 1)])
    assert [r["tokens"] for r in counts.orderBy("doc_id").collect()] == [len(model.encode(t or "", add_special_tokens=False)) for t in texts]


@pytest.mark.parametrize("text,want", [
    ("Mail: a.b+c@Lab-7.co.example.", ["a.b+c@Lab-7.co.example"]), ("<x9＠post.test>", ["x9＠post.test"]), ("u @ mail.invalid, ok", ["u @ mail.invalid"]),
    ("me_1 [at] a-b [dot] example", ["me_1 [at] a-b [dot] example"]), ("me at kontor [dot] co [dot] test now", ["me at kontor [dot] co [dot] test"]),
    ("ME (AT) STUDIO DOT EXAMPLE", ["ME (AT) STUDIO DOT EXAMPLE"]), ("mailto:q@w.example", ["q@w.example"]),
    ("thanks @handle, pack@1.2.3, node5@model-a:12, look at 0.5", []),
])
def test_mail_addresses(text, want):
    assert [text[a:b] for a, b in private.emails(text)] == want


@pytest.mark.parametrize("text", [
    "+49 30 23125 369", "07700 900802", "+44 7700 900435", "01 99 00 93 20", "(415) 555-0120", "0017135550154", "303-555-0112", "030/23125067", "415.555.0118",
    "+44 (0)20 7946 0196", "+33 1 99 00 05 74", "+1 713 555 0157",
])
def test_telephone_numbers(text):
    assert [m.group() for m in private.PHONE.finditer(f"Call {text}. Next")] == [text]


@pytest.mark.parametrize("text", [
    "PO Box 208, Pepiobury", "Tawnywoldweg 72b, Xatambach", "Marblecroftstraße 158, 00158 Gagudmere", "Calle Moltenmead 34, 00034 Yenerbury", "99 Opalfell Lane, Vaquenford",
    "279 rue des Willowgate, 00279 Ceranville", "165 Bramblewold Road\nUmorville", "21 Russetcroft Ave, Apt 22, Gagudbach, ZZ 00021",
])
def test_postal_addresses(text):
    assert [m.group() for m in private.ADDRESS.finditer(f"Ship to {text} Then more")] == [text]


def test_numbers_without_personal_meaning():
    assert not list(private.PHONE.finditer("Batch 512-5-512, row 50-576-1895508191, seed 4783927483, 1.2.3, 512x1024"))


def corpus():
    first, last = ["Alda", "Brev", "Corin", "Dael", "Flint"], ["Umber", "Vexley", "Wold", "Xan", "Yarrow"]
    docs, want = [], set()
    for n in range(40):
        name = f"{first[n % 5]} {last[(n * 7 + n // 5) % 5]}"
        docs.append((n, f"Load Noise Plus gives Sharp Edges.\nAuthor: {name}\nSet seed 12345678901 here. Ticket 12345{n:06d}. tax id 98765432{n:03d} ok"))
        want |= {(n, "name", name), (n, "idnum", f"98765432{n:03d}")}
    for n in range(40, 100):
        docs.append((n, f"Flint tones with Load Noise Plus. Ticket 99{n}, Ticket 1234567{n}9012. Set seed 12{n}456789. Batch 512-5{n % 10}-1728, Batch 12-{n}-17289"))
    docs += [(100, "Author: Briar Q. Vexley"), (101, "Author: Unheard Newname said"), (102, None), (103, ""), (None, "a@b.example"), (104, "x " * 300_000 + "Mail: me@post.test")]
    want |= {(100, "name", "Briar Q. Vexley"), (101, "name", "Unheard Newname"), (104, "email", "me@post.test")}
    known = [(p, "given") for p in first] + [(p, "family") for p in last] + [(None, "given"), (" ", "family"), ("Alda", "given")]
    return docs, known, want


def test_corpus_statistics_tell_names_and_numbers(spark):
    docs, known, want = corpus()
    d = spark.createDataFrame(docs, DOCS).withColumns({c: F.lit("clash") for c in ("kind", "first", "last", "found_text", "what", "n")})
    p = spark.createDataFrame(known, "name_part string, part_kind string")
    found = private.findings(d, p)
    assert {(r["doc_id"], r["kind"], r["found_text"]) for r in found.collect()} == want
    hidden = {r["doc_id"]: r["text"] for r in private.redact(d, found).collect() if r["doc_id"] is not None}
    assert hidden[100] == "Author: [NAME]" and hidden[102] is None and hidden[103] == "" and hidden[104].endswith("Mail: [EMAIL]")
    assert "[IDNUM] ok" in hidden[0] and "Ticket 12345000000" in hidden[0] and hidden[50] == docs[50][1]


def test_nothing_to_find(spark):
    d = spark.createDataFrame([], DOCS)
    p = spark.createDataFrame([], "name_part string, part_kind string")
    assert private.findings(d, p).count() == 0
    some = spark.createDataFrame([(1, "Author: Alda Umber")], DOCS)
    assert private.findings(some, p).count() == 0


def test_forms_that_no_pattern_knows(spark):
    rng = random.Random(8)
    first, last = ["Alda", "Brev", "Corin", "Dael", "Flint"], ["Umber", "Vexley", "Wold", "Xan", "Yarrow"]
    docs = []
    for n in range(80):
        name = f"{first[n % 5]} {last[(n * 7 + n // 5) % 5]}"
        docs.append((n, (
            f"Author: {name}\nCall me on +44 7700 9{n:02d}{n % 7}35 today. Ship it to {n + 1} Opalfell Lane, Vaquenford please. "
            f"My tax id 98765432{n:03d} holds. Set seed {rng.randrange(10**8)} and use Blur Tensor {n % 9}. Step {n % 12} of Load Noise Plus 2"
        )))
    new = {
        "phone": ["020 7946 0958", "0151 23456789", "555 0199 22", "+4915123456789", "1-800-555-0199"], "idnum": ["AB 12 34 56 7", "12.345.678-9", "2024 123 456 789"],
        "address": ["5 Oak Mews, Bristol", "1600 Pennsylvania Avenue NW, Washington, DC 20500", "221B Baker Street, London", "Via Roma 10, 00184 Roma", "Lange Gracht 12, 1012 Leiden"],
        "name": ["Sean O'Brien", "Fiona McDonald", "LI WEI", "Ludwig van Bergen", "Ana de la Cruz"],
    }
    lead = {"phone": "Call me on ", "idnum": "My tax id ", "address": "Ship it to ", "name": "Author: "}
    want = set()
    for kind, forms in new.items():
        for form in forms:
            docs.append((len(docs), f"{lead[kind]}{form}\n then seed 7654321 in Load Noise Plus 2"))
            want.add((docs[-1][0], kind, form))
    p = spark.createDataFrame([(x, "given") for x in first] + [(x, "family") for x in last], "name_part string, part_kind string")
    found = {(r["doc_id"], r["kind"], r["found_text"]) for r in private.findings(spark.createDataFrame(docs, DOCS), p).collect()}
    mine = {f for f in found if f[0] >= 80}
    missed, extra = want - mine, mine - want
    assert len(missed) <= 0.1 * len(want), missed
    assert len(extra) <= 2, extra
    assert len([f for f in found if f[0] < 80]) == 80 * 4
