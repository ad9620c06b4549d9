"""URL filter, line dedup, WARC, decontamination and PII: small tables and edge cases."""

import hashlib
import random
import re

import pytest

from sparkfold.llm.decontaminate import drop_leaks, find_leaks
from sparkfold.llm.line_dedup import dedup_lines
from sparkfold.llm.pii import find_pii, sanitise, span_strings
from sparkfold.llm.url_filter import filter_urls
from sparkfold.llm.warc_archive import archive_pages, restore, write_archive
from sparkfold.session import scratch_path

RULES = [("net", "/", "block"), ("a.net", "/x/", "allow"), ("b.a.net", "/", "block"), ("b.a.net", "/", "allow"), ("org", "/fr/", "allow"),
         (None, "/", "block"), ("org", None, "block")]


def rules(spark):
    return spark.createDataFrame(RULES, "host string, path string, verdict string")


def expected(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    best = None
    for h, p, v in RULES:
        if h is not None and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (), (len(h + p), v == "block", h + p, v))
    return host, path, best and best[2], best[3] if best else "allow"


def test_urls_against_every_rule(spark):
    rng = random.Random(4)
    hosts = ["net", "a.net", "B.a.NET", "c.b.a.net", "xa.net", "a.net.", "org", "q.org", "", "a-b.net", "net.com", "ä.net", ".net"]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/x', '/x/', '/X/y', '/fr/', '/fr'])}{rng.choice(['', '?q=/x/', '#/x/'])}" for _ in range(300)]
    urls += [None, "", "a.net/x/", "://", "x://a.net://b/", "http://a.net/x/\ny", *urls[:20]]
    table = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: r for r in filter_urls(table, rules(spark)).collect()}
    for i, u in enumerate(urls):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == expected(u), u


def test_urls_empty_inputs(spark):
    table = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [tuple(r) for r in filter_urls(table, rules(spark).limit(0)).collect()] == [(1, "a.net", "/", None, "allow")]
    assert filter_urls(table.limit(0), rules(spark)).count() == 0


def test_line_spread(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(k, f"head {k}\nboiler plate here\n\n tail {k}", f"s{k}") for k in range(4)]
    rows += [(10 + k, "same site line\nx", "one") for k in range(30)]            # often, but on one site
    rows += [(50, long, "p"), (51, f"{long}\nown words", "q"), (60, None, None), (61, "", "s"), (62, "three sites", "a"), (63, "three sites", "b"),
             (64, "three sites", None), (None, "boiler plate here", "z"), (2, rows[2][1], "s2")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, source string, pos int")
    out = dedup_lines(docs)
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows) and out.columns == ["doc_id", "text", "source", "pos", "n_lines", "n_removed"]
    assert got[0].text == rows[0][1] and got[0].n_removed == 0                    # the first one stays
    assert got[1].text == "head 1\n\n tail 1" and got[1].n_removed == 1
    assert got[10].text == got[39].text == "same site line\nx"
    assert got[50].text == long and got[51].text == "own words"
    assert got[60].text is None and got[61].text == "" and got[62].text == got[64].text == "three sites"
    assert got[None].text == "boiler plate here"
    assert dedup_lines(docs.limit(0)).count() == 0


def test_line_near_threshold_uses_exact_counts(spark):
    """Lines on exactly 299, 300 and 301 sites, threshold 300: far beyond what a sketch alone can tell apart."""
    rows = [(site * 10 + k, line, f"s{site}") for k, (line, n) in enumerate((("just below it", 299), ("just at it", 300), ("just above it", 301)))
            for site in range(n)]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_sites=300)
    removed = {r[0]: r[1] for r in got.groupBy("n_removed").count().collect()}
    assert removed == {0: 299 + 2, 1: 299 + 300}


def test_warc_round_trip(spark):
    big = "<p>é</p>" * 300
    rows = [(1, "http://a/", big), (5, "http://b/\r\nX: y", big), (3, None, big), (4, "u", None), (6, "u", ""), (7, "u", "small"), (8, "u", "small"),
            (9, "u", "x" * 999), (10, "u", "x" * 999), (11, "u", "y" * 1000), (12, "u", "y" * 1000), (12, "u", "y" * 1000), (None, "u", "lone" * 500)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, payload string").drop("payload")
    got = sorted((tuple(r) for r in archive_pages(spark, pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        owner = {big.encode(): 5, b"y" * 1000: 12}.get(b, i)
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "response" if owner == i else "revisit", None if owner == i else owner))
    assert got == sorted(want, key=repr)
    root = write_archive(pages, scratch_path(spark, "warc-test"))
    stored = spark.read.parquet(f"{root}/payloads")
    assert stored.count() == len({h or "" for _, _, h in rows})                   # every payload once
    for r in restore(spark, root).collect():
        head, body = bytes(r.record).split(b"\r\n\r\n", 1)
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1") and b"X" not in fields
        assert len(body) == int(fields[b"Content-Length"]) + 4 and body.endswith(b"\r\n\r\n")
        assert fields[b"WARC-Payload-Digest"] == b"sha1:" + hashlib.sha1(bytes(r.payload)).hexdigest().encode()
    assert archive_pages(spark, pages.limit(0)).count() == 0


def test_records_are_read_from_their_bytes(spark):
    from pyspark.sql import functions as F

    from sparkfold.llm.warc_archive import record_facts

    big = "é" * 600
    rows = [(1, "http://a/\u00fc", big), (2, "http://b", big), (2, "http://b", big), (3, None, "x\r\n\r\ny"), (4, "u", None), (None, "n", big), (None, "n", "only null ids")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    root = write_archive(pages, scratch_path(spark, "warc-test"))
    records = restore(spark, root)
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to, r.url) for r in record_facts(records).collect()), key=repr)
    assert got == sorted([(1, 1200, "revisit", 2, "http://a/\u00fc"), (2, 1200, "response", None, "http://b"), (2, 1200, "response", None, "http://b"),
                          (3, 6, "response", None, None), (4, 0, "response", None, "u"), (None, 1200, "revisit", 2, "n"), (None, 13, "response", None, "n")], key=repr)
    assert spark.read.parquet(f"{root}/payloads").count() == 4
    for broken in (F.substring(F.col("record"), F.lit(1), F.octet_length("record") - 1), F.concat("record", F.lit(b"z"))):
        with pytest.raises(Exception, match="contradicts"):
            record_facts(records.withColumn("record", broken)).collect()


QUESTION = "In spring Anna walked 12 km from Rome, then Anna rested 3 hours before the last 12 km home."


def test_leaks_and_new_parameters(spark):
    noise = "the quick brown fox jumps over lazy dogs near quiet rivers today"
    moved = "In spring Boris walked 45 km from Oslo, then Boris rested 7 hours before the last 45 km home."
    broken = "In spring Boris walked 45 km from Oslo, then Clara rested 7 hours before the last 99 km home."
    rows = [(1, f"{noise} {QUESTION} {noise}"), (2, f"{noise}\n{moved}"), (3, broken), (4, noise), (5, None), (6, ""), (7, QUESTION.upper()),
            (8, " ".join(QUESTION.split()[:4])), (1, f"{noise} {QUESTION} {noise}"), (None, QUESTION), (9, (noise + " ") * 3000 + QUESTION),
            (10, "five words stand right here"), (11, "x five words stand right here y")]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, item string")
    items = spark.createDataFrame([(1, QUESTION, 0), (1, QUESTION, 0), (2, None, 0), (3, "", 0), (4, "five words stand right here", 0), (None, QUESTION, 0)],
                                  "item_id long, text string, doc int")
    got = {(r.doc_id, r.item_id): r.kind for r in find_leaks(docs, items).collect()}
    assert got == {(1, 1): "verbatim", (2, 1): "reworded", (7, 1): "verbatim", (9, 1): "verbatim", (10, 4): "verbatim", (11, 4): "verbatim"}
    kept = drop_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["3", "4", "5", "6", "8", "None"])
    assert find_leaks(docs.limit(0), items).count() == 0
    assert find_leaks(docs, items.limit(0)).count() == 0 and drop_leaks(docs, items.limit(0)).count() == len(rows)


def test_leaks_in_other_case_and_wrapping(spark):
    moved = "In spring\nBoris walked 45 KM from  (Oslo), then \"Boris\" rested 7 hours before the last 45 km home."
    rows = [(1, QUESTION.upper()), (2, QUESTION.title()), (3, QUESTION.lower()), (4, "noise here " + QUESTION.replace(" ", "\n")), (5, moved),
            (6, "\ue000 " + QUESTION.upper().replace("12", "45")), (7, "IN SPRING ANNA STAYED AT HOME AND RESTED FROM ALL THE HOURS BEFORE")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    got = {r.doc_id: (r.kind, r.coverage) for r in find_leaks(docs, items).collect()}
    assert got == {1: ("verbatim", 1.0), 2: ("verbatim", 1.0), 3: ("verbatim", 1.0), 4: ("verbatim", 1.0), 5: ("reworded", 1.0), 6: ("reworded", 1.0)}


def test_leaks_with_some_contradicting_slots(spark):
    long = " ".join(f"plain{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(50)).split()
    first = " ".join([*long[:10], "12", *long[10:40], "12", *long[40:]])
    second = "if a boy has 3 apples and his sister gets 5 pears how many fruits do they have then"
    third = "the road runs 8 km through the old forest and then it goes on for 8 km along the wide river bank"
    items = spark.createDataFrame([(1, first), (2, second), (3, third)], "item_id long, text string")
    rows = [(1, first[::-1].replace("21", "31", 1)[::-1]), (2, second.replace("3", "4").replace("5", "4")), (3, third.replace("km", "miles", 1))]
    got = {(r.doc_id, r.item_id): r.kind for r in find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert "13" in rows[0][1]
    assert got == {(1, 1): "verbatim", (2, 2): "reworded", (3, 3): "verbatim"}


def test_leaks_with_few_literal_words(spark):
    texts = ["12 7 45 3 9 88 21 5 6 14 33 2", "5 km 3 miles 12 kg 9 hours", "we met Anna Boris Clara David Emil Frieda Gustav Hanna Ida",
             "How tall is Mount Everest", "What is 17 times 23"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    noise = "the quick brown fox jumps over lazy dogs"
    rows = [(k, f"{noise} {x} {noise}") for k, x in enumerate(texts)]
    rows += [(10, "99 98 97 96 95 94 93 92 91 90 89 87"), (11, "What is 18 times 24"), (12, noise)]
    got = {(r.doc_id, r.item_id): (r.kind, r.coverage) for r in find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert got == {(k, k): ("verbatim", 1.0) for k in range(5)}


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for k, pattern in ((2, CARD), (3, PHONE)):
        for m in pattern.finditer(text):
            d = re.sub("[^0-9]", "", m.group())
            if (12 <= len(d) <= 19 and luhn(d)) if k == 2 else 9 <= len(d) <= 15:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_base_spans_against_re(spark):
    rng = random.Random(3)
    parts = ["a", "b.c", "@", "@x.y", "_", "12", "3", ".", " ", "-", "+1", "(", ")", "4111 1111-11111111", "é", "\n", "😀", "192.168.0.1", "..", "%",
             "\ue001", "@k-l.m", "+49 30 1234567"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    texts += [None, "", "1" * 100_000 + " a@b" + ".c" * 50_000 + " 4 1" * 20_000]            # no recursion in the patterns
    docs = spark.createDataFrame([(i % 900, t, i) for i, t in enumerate(texts)], "doc_id long, text string, base int")
    got = {r.text: r.base_spans for r in span_strings(find_pii(docs)).collect()}
    for t in texts:
        assert got[t or ""] == base(t or "")


def test_disclosing_terms(spark):
    """A word found with one address only, in different contexts, is a span; a word found everywhere is not."""
    fill = [f"plain words number {w} stand about here" for w in "abcdefghij"]
    rows = [(i, f"{fill[i]} quixotl of the office wrote jd@mail.com about {fill[-1 - i]}") for i in range(3)]
    rows += [(10 + i, f"the office wrote nothing {fill[i % 10]}") for i in range(60)] + [(None, "jd@mail.com"), (99, None)]
    out = sanitise(span_strings(find_pii(spark.createDataFrame(rows, "doc_id long, text string"))))
    got = {r.doc_id: r for r in out.collect()}
    for i in range(3):
        at = rows[i][1].index("quixotl")
        assert f"term:{at}:{at + 7}" in got[i].spans and "jd@mail.com" not in got[i].clean_text and "quixotl" not in got[i].clean_text
        assert " office wrote [EMAIL]" in got[i].clean_text
    assert got[10].spans == "" and got[10].clean_text == rows[3][1]
    assert got[None].clean_text == "[EMAIL]" and got[99].clean_text == ""
    assert find_pii(out.select("doc_id", "text").limit(0)).count() == 0


def test_disclosing_terms_far_from_the_address(spark):
    """A flagged word is a span wherever it stands; documents in which it stands far from the address count as well."""
    far = " ".join(["plain words stand about here"] * 20)
    rows = [(1, f"first quixotl of the office wrote jd@mail.com at once. {far} Quixotl again"),
            (2, f"second note by quixotl to jd@mail.com. {far}"),
            (3, f"zarbatane came. {far} then jd@mail.com wrote to somebody else"), (4, f"so zarbatane wrote jd@mail.com a line {far}"),
            (5, f"only the name quixotl, no address {far}"), (6, "mail to xquixotly")]
    rows += [(10 + i, f"the office wrote nothing to somebody else at once {far}") for i in range(300)]
    out = {r.doc_id: r for r in sanitise(span_strings(find_pii(spark.createDataFrame(rows, "doc_id long, text string")))).collect()}
    for i, text in rows[:6]:
        spans = [x for x in out[i].spans.split(",") if x.startswith("term")]
        want = [f"term:{m.start()}:{m.end()}" for m in re.finditer(r"(?i)\b(quixotl|zarbatane)\b", text)]
        assert set(want) <= set(spans) and not re.search(r"(?i)\b(quixotl|zarbatane)\b", out[i].clean_text)
    assert out[6].clean_text == "mail to xquixotly" and out[10].spans == ""


def test_terms_against_brute_force_counts(spark):
    """Flagged (document, term) pairs from direct co-occurrence counts, the entity anywhere in its documents."""
    import collections
    import math
    import random

    from sparkfold.llm.pii import find_pii

    rng = random.Random(8)
    people = {f"p{k}@x.org": f"name{chr(97 + k) * 3}" for k in range(6)}
    texts = []
    for k in range(160):
        words = [rng.choice("alpha beta gamma delta omega sigma kappa theta".split()) + rng.choice("xyz") for _ in range(60)]
        if k % 9 == 0:
            mail = rng.choice(sorted(people))
            words.insert(0, mail)
            words[rng.randrange(30, 55)] = people[mail] if rng.random() < 0.9 else "nobody"
        elif k % 31 == 0:
            words[5] = rng.choice(sorted(people.values()))
        texts.append(" ".join(words))
    texts += [texts[0], None, ""]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, term string")
    got = {(r.doc_id, t.lower()) for r in find_pii(docs).collect() for t in [r.text[s.start:s.stop] for s in r.terms]}
    mails, contexts, words = collections.defaultdict(set), collections.defaultdict(set), collections.defaultdict(set)
    for k, t in enumerate(texts):
        t = t or ""
        found = [m for m in re.finditer(r"[a-z0-9.]+@[a-z.]+", t)]
        for w in re.findall(r"[a-z]{3,}", re.sub(r"[a-z0-9.]+@[a-z.]+", " ", t)):
            words[w].add(k)
        for m in found:
            mails[m.group()].add(k)
            after = t[m.end():m.end() + 80]
            contexts[m.group(), k].add(tuple(re.findall(r"(?<=[^a-z])[a-z]+(?=[^a-z])", after)))
    flagged = set()
    for mail, own in mails.items():
        for w, has in words.items():
            share = len(own & has) / len(has)
            if share >= 0.5 and math.log2(share / (len(own) / len(texts))) >= 4 and len(set().union(*(contexts[mail, k] for k in own & has))) >= 2:
                flagged.add(w)
    assert flagged and any(w.startswith("name") for w in flagged)
    assert got == {(k, w) for w in flagged for k in words[w]}
