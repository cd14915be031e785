"""Quality rules, mixing, winnowing, line dedup and pseudonyms against plain versions."""

import datetime
import hashlib
import math
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from leafmill.llm import lines, mixing, pseudonyms, quality, winnowing
from tests.llm.data import frame, found, rows, words_of

SPACES = " \t\n\x0b\x0c\r"


def plain_measures(text):
    text = text or ""
    words = [w.decode() for w in words_of(text)]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if seen[g] > 1 for j in range(8)}
    own = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(own) - len(set(own)), len(covered)


@pytest.mark.parametrize("extra", [False, True])
def test_quality_counts_and_base_rules(spark, extra):
    got = {r["doc_id"]: r for r in quality.judged(frame(spark, extra=extra)).collect()}
    for i, text, _ in rows():
        want = plain_measures(text)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, i
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r["kept"] == (not r["base_failed"] and not r["host_failed"])


def test_a_bad_host_loses_its_good_pages_and_a_small_one_is_pulled_to_the_mean(spark):
    good = " ".join(f"word{i}" for i in range(40))
    data = [(i, "bad", "junk") for i in range(60)] + [(100, good, "junk")]
    data += [(200 + i, good if i % 10 else "short", f"fine{i % 5}") for i in range(300)]
    data += [(900, "tiny", "lone"), (901, good, "lone")]
    got = {r["doc_id"]: r for r in quality.judged(frame(spark, data)).collect()}
    assert not got[100]["base_failed"] and not got[100]["kept"] and got[100]["host_failed"]
    assert got[201]["kept"] and got[901]["kept"]
    rates = {(r["source"], r["rule"]): r for r in quality.host_rates(quality.measures(frame(spark, data))).collect()}
    assert rates["lone", "few_words"]["rate"] < 0.5 < rates["junk", "few_words"]["rate"] < 60 / 61


def test_hosts_that_do_not_differ_share_one_rate(spark):
    data = [(i, "short", f"h{i % 3}") for i in range(9)]
    assert {round(r["rate"], 9) for r in quality.host_rates(quality.measures(frame(spark, data))).filter("rule = 'few_words'").collect()} == {1.0}


def test_empty_tables(spark):
    none = frame(spark, [])
    assert quality.judged(none).collect() == []
    assert mixing.mixture(none).collect() == []
    assert mixing.mixed_documents(none).collect() == []
    assert winnowing.fingerprints(none).collect() == []
    assert lines.line_report(none).collect() == []
    assert lines.without_boilerplate(none).columns == none.columns
    assert pseudonyms.pseudonyms(none, "k").collect() == []


# Winnowing.


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chain(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64(v.to_bytes(8, "little", signed=True), seed=seed).intdigest()
    return signed(seed)


def plain_print(text):
    h = [signed(xxhash.xxh64(w, seed=42).intdigest()) for w in words_of(text)]
    grams = [chain(h[i : i + 5]) for i in range(len(h) - 4)] or ([chain(h)] if h else [])
    places = []
    for i in range(max(1, len(grams) - 3) if grams else 0):
        window = grams[i : i + 4]
        place = i + max(j for j, x in enumerate(window) if x == min(window))
        if not places or places[-1] != place:
            places.append(place)
    return {grams[p] for p in places}, " ".join(f"{grams[p] & (2**64 - 1):X}:{p}" for p in places)


def plain_likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize(("extra", "bucket_rows", "parts"), [(False, 7, 1024), (True, 7, 3), (True, 1, 2)])
def test_fingerprints(spark, extra, bucket_rows, parts, monkeypatch):
    monkeypatch.setattr(winnowing, "BUCKET_ROWS", bucket_rows)
    monkeypatch.setattr(winnowing, "PARTS", parts)
    data = rows()
    got = {r["doc_id"]: r for r in winnowing.fingerprints(frame(spark, data, extra)).collect()}
    ordered = sorted(data)
    assert len(got) == len(data)
    for (i, text, _), (_, after, _) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, after = text or "", after or ""
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        (own, own_print), (changed, changed_print) = plain_print(text), plain_print(edited)
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (own_print, changed_print)
        assert r["near_edited"] == pytest.approx(plain_likeness(own, changed))
        assert r["near_next"] == pytest.approx(plain_likeness(own, plain_print(after)[0]))


def test_fingerprints_of_one_document_and_of_repeated_and_null_ids(spark):
    one = winnowing.fingerprints(frame(spark, [(5, "abcd efgh", "x")])).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"abcd efab").hexdigest()
    data = [(None, "q" * 8, "x"), (1, "a" * 8, "x"), (1, "b" * 8, "x"), (1, "b" * 8, "x"), (2, "c" * 8, "x")]
    got = Counter((r["doc_id"], r["edited_sha256"]) for r in winnowing.fingerprints(frame(spark, data)).collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == Counter([(None, sha("qqqqqqaa")), (1, sha("aaaaaabb")), (1, sha("b" * 8)), (1, sha("bbbbbbcc")), (2, sha("ccccccqq"))])


def test_buckets_are_even_however_ids_are_spread(spark, monkeypatch):
    """Half of the ids close together, half far apart: no bucket holds many times the rows asked for."""
    monkeypatch.setattr(winnowing, "BUCKET_ROWS", 10)
    ids = list(range(1000)) + [10**6 + 10**9 * i for i in range(1000)]
    placed = winnowing.with_next(frame(spark, [(i, f"t{i}", "x") for i in ids])).collect()
    sizes = Counter(r["bucket"] for r in placed if not r["guest"])
    assert len(placed) - sum(sizes.values()) == len(sizes) and len(sizes) > 150 and max(sizes.values()) <= 30
    after = dict(zip(ids, ids[1:] + ids[:1], strict=True))
    assert {r["doc_id"]: r["next_text"] for r in placed if not r["guest"]} == {i: f"t{after[i]}" for i in ids}


def test_a_long_shared_run_is_always_found(spark):
    shared = " ".join(f"s{i}" for i in range(8))
    data = [(i, " ".join(f"d{i}x{j}" for j in range(30)) + " " + shared + " " + " ".join(f"d{i}y{j}" for j in range(30)), "x") for i in range(20)]
    prints = [set(x["fingerprint"].split()) for x in winnowing.fingerprints(frame(spark, data)).collect()]
    hashes = [{p.split(":")[0] for p in one} for one in prints]
    assert all(a & b for a in hashes for b in hashes)


# Lines.


def test_boilerplate_lines_go(spark):
    data = [(i, f"Own {i}\nMENU\n\n  \nlast {i}" if i % 2 else f"Own {i}\r\nrare", "h") for i in range(40)]
    data += [(100 + i, f"MENU\nkept {i}", "small") for i in range(2)] + [(200, None, "h"), (201, "MENU\nMENU", "h"), (202, "MENU", None)]
    got = {r["doc_id"]: r["text"] for r in lines.without_boilerplate(frame(spark, data, True)).collect()}
    assert got[1] == "Own 1\n\n  \nlast 1" and got[100] == "MENU\nkept 0" and got[200] is None and got[201] == "" and got[202] == "MENU"
    assert got[0] == "Own 0" + "\r"
    report = {r["doc_id"]: r for r in lines.line_report(frame(spark, data)).collect()}
    assert (report[201]["n_lines"], report[201]["n_removed"], report[200]["n_lines"]) == (2, 2, 0)


def plain_lines(data, ratio=0.1, prior=20):
    pages = defaultdict(set)
    for _, text, host in data:
        pages[host].add(text or "")
    common = {}
    for host, texts in pages.items():
        hits = Counter(x for t in texts for x in set(t.split("\n")) if words_of(x))
        common[host] = {x for x, n in hits.items() if n > ratio * (len(texts) + prior)}
    return Counter((i, None if t is None else "\n".join(x for x in t.split("\n") if x not in common[h])) for i, t, h in data)


def test_lines_of_small_hosts_and_of_copies(spark):
    footer = [(i, f"page {i}\nfooter", "nineteen") for i in range(19)]
    few = [(100 + i, f"story {i}\nits end", "ten") for i in range(9)]
    copied = [(200, "a story\nof its own", "ten"), (201, "a story\nof its own", "ten"), (201, "a story\nof its own", "ten")]
    pair = [(300, "one text\nand its end", "two"), (301, "one text\nand another", "two")]
    long = [(400 + i, "\n".join(f"line {j}" for j in range(i, i + 90)), "long") for i in range(60)]
    data = footer + few + copied + pair + long + [(500, None, "ten"), (501, "", None), (502, "page 1\nfooter", None)]
    got = lines.without_boilerplate(frame(spark, data))
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == plain_lines(data)
    text = {r["doc_id"]: r["text"] for r in got.collect()}
    assert text[3] == "page 3" and text[201] == "a story\nof its own" and text[300] == "one text\nand its end" and text[100] == "story 0"


def test_extra_columns_pass_through(spark):
    docs = frame(spark, extra=True)
    assert lines.without_boilerplate(docs).columns == docs.columns
    assert found(lines.without_boilerplate(docs).select("doc_id", "host", "`a b`")) == found(docs.select("doc_id", "host", "`a b`"))
    assert mixing.mixed_documents(docs).columns == docs.columns


# Mixing.


def skewed():
    return [(i, " ".join(["w"] * (5 + i % 7)), "big") for i in range(600)] + [(1000 + i, "a b c d e f", f"s{i % 4}") for i in range(80)] + [(5000, None, None)]


def test_weights_meet_the_entropy_and_quotas_are_kept(spark):
    mix = mixing.Mix(entropy=0.8, repetition=1e9, block_tokens=500)
    got = mixing.mixture(frame(spark, skewed()), mix).collect()
    weight = {r["source"]: r["weight"] for r in got}
    have = defaultdict(int)
    for _, text, source in skewed():
        have[source] += max(1, len(words_of(text)))
    total = sum(have.values())
    entropy = -sum(w * math.log(w) for w in weight.values())
    assert sum(weight.values()) == pytest.approx(1, abs=1e-9)
    assert 0.8 * math.log(len(have)) - 1e-4 <= entropy <= 0.8 * math.log(len(have)) + 1e-3
    used = Counter()
    for r in got:
        used[r["source"]] += r["n_tokens"]
    for s, w in weight.items():
        assert w * total - 1 <= used[s] < w * total + 12
    per_doc = Counter((r["doc_id"], r["epoch"]) for r in got)
    assert set(per_doc.values()) == {1}
    blocks = defaultdict(list)
    for r in got:
        blocks[r["block"]].append(r["slot"])
    assert all(sorted(b) == list(range(1, len(b) + 1)) for b in blocks.values()) and len(blocks) == -(-sum(int(w * total + 1e-6) for w in weight.values()) // 500)
    share = Counter()
    for r in got:
        if r["source"] == "big":
            share[r["block"]] += r["n_tokens"]
    assert max(share.values()) - min(share.values()) < 40


def test_the_repetition_limit_wins(spark):
    got = mixing.mixture(frame(spark, skewed()), mixing.Mix(entropy=0.99, repetition=2.0)).collect()
    assert max(r["epoch"] for r in got) <= 1
    uses = Counter(r["doc_id"] for r in got)
    docs = Counter(r["doc_id"] for r in mixing.mixed_documents(frame(spark, skewed()), mixing.Mix(entropy=0.99, repetition=2.0)).collect())
    assert uses == docs


def plain_schedule(data, quota):
    """Uses per source: passes in the order of each epoch until a document reaches the quota."""
    used = defaultdict(list)
    for source, most in quota.items():
        own = [(i, n) for i, s, n in data if s == source]
        total, epoch = 0, 0
        while total < most:
            for i, n in sorted(own, key=lambda d: order(epoch, d[0])):
                if total < most:
                    used[source].append((i, epoch, total))
                    total += n
            epoch += 1
    return used


def order(epoch, key):
    return (key * 2654435761 + epoch * 97) % 1009


def test_quotas_are_filled_whatever_the_lengths(spark, monkeypatch):
    data = [(i, "small", 1 + i % 9) for i in range(100)] + [(200, "one", 10_000)] + [(300 + i, "some", 700) for i in range(3)]
    monkeypatch.setattr(mixing, "_order", lambda key, epoch, seed: ((key * 2654435761 + epoch * 97) % 1009).cast("long"))
    counts = spark.createDataFrame([(i, s, n, i) for i, s, n in data], "doc_id long, source string, tokens long, key long")
    quota = {"small": 1200, "one": 6831, "some": 1500}
    own = {s: sum(n for _, x, n in data if x == s) for s in quota}
    plan = spark.createDataFrame([(s, own[s], 0.3, q) for s, q in quota.items()], "of string, source_tokens long, weight double, quota long")
    got = defaultdict(list)
    for r in mixing.schedule(counts, plan, mixing.Mix()).collect():
        got[r["source"]].append((r["doc_id"], r["epoch"], r["start"]))
    want = plain_schedule(data, quota)
    assert {s: sorted(u) for s, u in got.items()} == {s: sorted(u) for s, u in want.items()} and got["one"] == [(200, 0, 0)]


def test_one_source_is_used_whole(spark):
    data = [(i, "a b c", "only") for i in range(10)]
    got = mixing.mixture(frame(spark, data)).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(10)) and {r["weight"] for r in got} == {1.0}


def test_at_exponent_one_every_source_gets_its_own_tokens(spark):
    have = {f"s{i}": 10**12 + 7919 * i * i for i in range(20)}
    counts = spark.createDataFrame([(i, s, n, i) for i, (s, n) in enumerate(have.items())], "doc_id long, source string, tokens long, key long")
    plan = mixing.quotas(counts, mixing.Mix())
    assert {r["of"]: r["quota"] for r in plan.collect()} == have
    assert sorted((r["source"], r["epoch"]) for r in mixing.schedule(counts, plan, mixing.Mix()).collect()) == sorted((s, 0) for s in have)


def test_orders_do_not_depend_on_partitions(spark):
    a = mixing.mixture(frame(spark, skewed()).repartition(1))
    b = mixing.mixture(frame(spark, skewed()).repartition(7))
    assert found(a) == found(b)


# Pseudonyms.


def luhn(number):
    digits = [int(c) for c in number if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


VALUES = {
    "card": ["4785380592391139", "4111 1111 1111 1111", "3782-822463-10005"],
    "phone": ["+1 (743) 555-3824", "+44 20 7946 0958"],
    "ip": ["70.23.22.57", "255.255.255.255", "0.0.0.0"],
    "ssn": ["123-45-6789", "899-99-9999", "665-01-0001", "001-01-0001"],
    "iban": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
    "date": ["2024-02-29", "31/12/1999", "12/25/2020", "01.02.1700", "2099-12-31"],
    "email": ["hein.19@mail5.example.com", "Bob_Smith+x@Ab.co", "a@b.de"],
}
LOOKALIKES = ["1234567890123456", "300.1.1.1", "666-45-6789", "000-12-3456", "DE88370400440532013000", "2023-02-29", "31/02/1999", "1.2.3", "12345", "a@b", "2.0."]


def shape(value):
    return "".join("9" if c.isdigit() else c if not c.isalnum() else "a" if c.islower() else "A" for c in value)


def test_valid_values_change_keep_their_shape_and_come_back(spark):
    data = [(i, f"see {v}, or\n{v}### ok", kind) for i, (kind, v) in enumerate((k, v) for k, vs in VALUES.items() for v in vs)]
    made = pseudonyms.pseudonyms(frame(spark, data, True), "key")
    back = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonyms(made.select("doc_id", "text"), "key", back=True).collect()}
    other = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonyms(frame(spark, data), "another").collect()}
    for r in made.collect():
        _, text, kind = data[r["doc_id"]]
        value = text[4 : text.index(", or")]
        fresh = r["text"][4 : r["text"].index(", or")]
        assert r["n_replaced"] == r[f"n_{kind}"] == 2, value
        if len(value) > 6:
            assert fresh != value and r["text"] != other[r["doc_id"]]
        assert r["text"].count(fresh) == 2 and back[r["doc_id"]] == text
        if kind != "ip":
            assert shape(fresh) == shape(value)
        if kind == "card":
            assert luhn(fresh)


def test_a_number_beside_a_phone_is_not_part_of_it(spark):
    data = [(0, "+1 (743) 555-3824", "s"), (1, "+1 (743) 555-3824 19", "s"), (2, "+1 (743) 555-3824 4785380592391139", "s")]
    got = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonyms(frame(spark, data), "key").collect()}
    assert got[1] == got[0] + " 19" and got[2].startswith(got[0] + " ") and luhn(got[2].split()[-1])


RUN_ON = [
    ("ES91 2100 0418 4502 0005 1332 BIC", {"iban": 1}),
    ("BE68 5390 0754 7034 2024", {"iban": 1}),
    ("AT611904300234573201 EUR", {"iban": 1}),
    ("MU17BOMM0101101030300200000MUR", {"iban": 1}),
    ("+1 415 555 2671 4111 1111 1111 1111", {"phone": 1, "card": 1}),
    ("+44 20 7946 0958 4111 1111 1111 1111", {"phone": 1, "card": 1}),
]


def test_values_do_not_run_on_into_what_follows(spark):
    data = [(i, f"to {text}, ok", "s") for i, (text, _) in enumerate(RUN_ON)]
    made = pseudonyms.pseudonyms(frame(spark, data), "key")
    back = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonyms(made.select("doc_id", "text"), "key", back=True).collect()}
    for r in made.collect():
        text, kinds = RUN_ON[r["doc_id"]]
        assert {k: r[f"n_{k}"] for k in VALUES if r[f"n_{k}"]} == kinds, text
        assert shape(r["text"]) == shape(data[r["doc_id"]][1]) and r["text"] != data[r["doc_id"]][1] and back[r["doc_id"]] == data[r["doc_id"]][1]


SHAPES = ["{d:02}/{m:02}/{y}", "{d}/{m:02}/{y}", "{d:02}.{m}.{y}", "{y}-{m}-{d}", "{m:02}/{d:02}/{y}", "{m}/{d:02}/{y}"]


@pytest.mark.parametrize("written", SHAPES)
def test_every_date_of_a_shape_has_a_pseudonym_of_its_own_and_comes_back(spark, written):
    days = [datetime.date(1700, 1, 1) + datetime.timedelta(i) for i in range(146_097)]
    month_first = written.startswith("{m")
    days = [x for x in days if ("{d}" not in written or x.day < 10) and ("{m}" not in written or x.month < 10) and (not month_first or x.day > 12)]
    texts = [written.format(y=x.year, m=x.month, d=x.day) for x in days]
    frame_ = spark.createDataFrame([(t,) for t in texts], "v string").repartition(8)
    made = frame_.select("v", pseudonyms.pseudonym(F.col("v"), "key").alias("p"))
    got = made.select("v", "p.kind", F.col("p.value").alias("w"), pseudonyms.pseudonym(F.col("p.value"), "key", True)["value"].alias("back")).toPandas()
    assert set(got["kind"]) == {"date"} and (got["v"] == got["back"]).all()
    # Every shape keeps to itself, and all of its dates are used.
    assert set(got["w"]) == set(texts) and (got["v"] != got["w"]).mean() > 0.999


FOUND = {"743-555-3824": "phone", "(743) 555-3824": "phone", "1-743-555-3824": "phone", "743.555.3824": "phone"}
FOUND |= {"_bob@example.com": "email", ".bob@example.com": "email", "bob@exämple.com": "email", "jürgen@example.com": "email", "άννα.иван@example.com": "email"}
FOUND |= {"2021-3-7": "date", "3/7/2021": "date", "13/7/2021": "date", "7/13/2021": "date", "29.2.2020": "date"}
NOT_FOUND = ["123-456-7890", "743-155-3824", "743-555-38245", "12-743-555-3824-1", "2021-13-7", "2021-2-29", "0/7/2021"]


def test_national_numbers_marked_names_and_short_dates_are_found_whole(spark):
    data = [(i, f"at {v}, 联系{v}谢谢" if kind == "email" else f"at {v}, ({v})", "s") for i, (v, kind) in enumerate(FOUND.items())]
    data += [(100 + i, f"no {v} ok", "s") for i, v in enumerate(NOT_FOUND)]
    made = pseudonyms.pseudonyms(frame(spark, data), "key")
    back = {r["doc_id"]: r["text"] for r in pseudonyms.pseudonyms(made.select("doc_id", "text"), "key", back=True).collect()}
    texts = {i: t for i, t, _ in data}
    for r in made.collect():
        assert back[r["doc_id"]] == texts[r["doc_id"]]
        if r["doc_id"] >= 100:
            assert r["n_replaced"] == 0 and r["text"] == texts[r["doc_id"]], r
            continue
        value, kind = list(FOUND.items())[r["doc_id"]]
        assert r[f"n_{kind}"] == r["n_replaced"] == 2, r
        name = value.split("@")[0]
        assert value not in r["text"] and not any(c in r["text"].split("@")[0] for c in name if ord(c) > 127), r


def test_lookalikes_nulls_and_plain_texts_stay(spark):
    data = [(i, f"x {v} y", "s") for i, v in enumerate(LOOKALIKES)] + [(50, None, "s"), (51, "", "s"), (52, "9" * 50_000 + "@", "s")]
    for r in pseudonyms.pseudonyms(frame(spark, data), "key").collect():
        assert r["text"] == dict((i, t) for i, t, _ in data)[r["doc_id"]] and r["n_replaced"] == 0


def test_small_domains_are_permuted_one_to_one(spark):
    a, b = F.lit(7).cast("long"), F.lit(11).cast("long")
    got = spark.range(77).select(pseudonyms.permuted(F.col("id"), a, b, "k", "t").alias("x")).select("x", pseudonyms.permuted(F.col("x"), a, b, "k", "t", True).alias("y"))
    assert sorted(r["x"] for r in got.collect()) == list(range(77)) and sorted(r["y"] for r in got.collect()) == list(range(77))
