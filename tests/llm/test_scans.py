"""License scans, secret scans and mixing against brute force."""

import hashlib
import math
import random
import re
import string
import time
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seatloom.llm import license_scan, mixing, secret_scan

LOW = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute_license(doc_id, text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    hits = []
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        hits += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    starts = [i for i, _ in hits]
    return (doc_id, len(w), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits})))


def brute_templates(text):
    """By the definition: any run of at most 1.5 times the template's words that holds 0.8 of its distinct words and all required ones."""
    find = lambda t: re.findall(license_scan.WORD, (t or "").translate(LOW))
    words, out = find(text), {}
    for name, (template, required) in license_scan.TEMPLATES.items():
        own, must = set(find(template)), set(find(required))
        length = -(-3 * len(find(template)) // 2)
        for i in range(len(words)):
            held = set(words[i : i + length]) & own
            if must <= held and len(held) / len(own) >= license_scan.THRESHOLD - 1e-9:
                out[name] = max(out.get(name, 0), len(held) / len(own))
    return out


def test_license_scan(spark, odd, none, real):
    more = spark.createDataFrame(
        [(1, "x CC-BY y cc by\nAll  Rights... Reserved"), (2, "Permission granted, free of charge, to any person obtaining a copy of this software and associated documentation files is hereby"),
         (3, "Licensed under the Apache License, Version 2.0"), (4, "general public\nlicense general public license")],
        "doc_id long, text string",
    )
    for docs in (odd, real, more):
        texts = [(r.doc_id, r.text) for r in docs.collect()]
        got = license_scan.scan(docs).collect()
        assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == Counter(brute_license(*t) for t in texts)
        want = Counter((d, ",".join(sorted(set(brute_license(d, t)[5].split(",")) - {""} | set(brute_templates(t))))) for d, t in texts)
        assert Counter((r.doc_id, r.labels) for r in got) == want
        score = lambda d, t: 1.0 if brute_license(d, t)[2] else max(brute_templates(t).values(), default=0.0)
        assert Counter((r.doc_id, round(r.score, 9)) for r in got) == Counter((d, round(score(d, t), 9)) for d, t in texts)
    assert license_scan.scan(none).count() == 0


def test_license_scan_of_wrapped_notices(spark):
    rows = [
        (1, "lead words\n# Permission is hereby granted, free of charge, to any person obtaining\n# a copy of this software and associated documentation files\n# more"),
        (2, "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided"),
        (3, "/* Licensed under the Apache\n *\n * License, Version 2.0 */"),
        (4, "Redistribution and use in source " + "filler " * 40 + "\nand binary forms, with or without modification, are permitted"[:30]),
        (5, "modification are permitted\nredistribution and use in source and binary\n\nforms with or without"), (6, "Released under\nthe MIT\nLicense"),
        (7, "the of to in and or with is this any under " * 2000),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_scan.scan(docs).collect()}
    assert got == {1: "mit-grant", 2: "bsd", 3: "apache-2.0", 4: "", 5: "bsd", 6: "mit", 7: ""}


def test_license_scan_tells_kin_apart(spark):
    """False hits that word bags give: variants of one license, long lines that hold a template's words far apart."""
    rows = [
        (1, "Licensed under CC BY-SA 4.0"), (2, "Licensed under CC BY-NC 4.0."), (3, "the notes released last week fall under a driving license of the state"),
        (4, "Released under the terms of the MIT License"), (5, "Released " + "and so on " * 20 + "under the MIT License"), (6, "license MIT the under released"),
        (7, "copyright notices: all of the rights are reserved"), (8, "Copyright 2020, all rights are reserved"), (9, "CC BY 4.0 licensed under"),
    ]
    got = {r.doc_id: r.labels for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {d: ",".join(sorted(set(brute_license(d, t)[5].split(",")) - {""} | set(brute_templates(t)))) for d, t in rows}
    assert got == want
    assert [want[i] for i in (1, 2, 3, 4, 5, 6)] == ["cc-by,cc-by-sa", "cc-by,cc-by-nc", "", "mit", "mit", "mit"] and want[9] == "cc-by"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("licensed under cc by nc sa 4 0 the mit license released x y\n".split(" ")), max_size=40), min_size=1, max_size=12))
def test_license_scan_of_any_words(spark, texts):
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    got = {r.doc_id: (r.labels, round(r.score, 9)) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, t in rows:
        base, added = brute_license(d, t), brute_templates(t)
        assert got[d] == (",".join(sorted(set(base[5].split(",")) - {""} | set(added))), 1.0 if base[2] else round(max(added.values(), default=0.0), 9))


def brute_base(text):
    text = text or ""
    spans = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            spans.append((m.start(), 0, m.end()))
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


@pytest.fixture(scope="module")
def secrets(spark):
    rng = random.Random(5)
    key = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    rows = [(i, f"plain words stand here {key(string.ascii_letters + string.digits + '+/', 40)} and there") for i in range(30)]
    rows += [(100 + i, f'API_KEY: "{key("abc123._-", 8)}" 😀 pass = x') for i in range(3)]
    rows += [(200, f"AKIA{key(string.ascii_uppercase, 16)} AKIA12 {key('0123456789abcdef', 64)} token=abc"), (201, "password: hunter2hunter2" + "0" * 40)]
    rows += [(300 + i, "internationalizationandlocalization_of_many_many_words " * 4) for i in range(200)]
    rows += [(600, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"), (601, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_secret_base(odd, none, real, secrets):
    for docs in (odd, real, secrets):
        texts = [(r.doc_id, r.text) for r in docs.collect()]
        want = Counter()
        for d, t in texts:
            b = brute_base(t)
            shown = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in b)
            n = Counter(k for _, k, _ in b)
            want[d, n[0], n[1], n[2], hashlib.sha256(shown.encode()).hexdigest()] += 1
        got = secret_scan.digest(secret_scan.scan(docs)).collect()
        assert Counter(tuple(r)[:5] for r in got) == want
    assert secret_scan.scan(none).count() == 0


def brute_added(texts, rate=0.001):
    """Spans of the randomness battery by its definition, for each text."""
    every = "".join(t or "" for t in texts)
    classes = ((string.ascii_lowercase, 26), (string.ascii_uppercase, 26), (string.digits, 10), ("+/_-", 4))
    seen = [sum(map(every.count, letters)) + 1 for letters, _ in classes]
    costs = [-math.log(n / sum(seen) / size) for n, (_, size) in zip(seen, classes, strict=True)]
    alphabets = {16: "0123456789abcdef", 32: string.ascii_uppercase + "234567", 36: string.digits + string.ascii_lowercase, 64: string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/"}
    found = []
    for d, t in enumerate(texts):
        base = brute_base(t)
        for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", t or ""):
            if any(s < m.end() and m.start() < e for s, _, e in base):
                continue
            v = m[0].rstrip("=")
            k = 16 if re.fullmatch("[0-9a-f]+|[0-9A-F]+", v) else 32 if re.fullmatch("[A-Z2-7]+", v) else 36 if re.fullmatch("[0-9a-z]+", v) else 64
            ratio = sum(c * sum(x in letters for x in v) for c, (letters, _) in zip(costs, classes, strict=True)) - len(v) * math.log(k)
            letters = alphabets[k].upper() if k == 16 and v != v.lower() else alphabets[k]
            codes = [letters.find(c) for c in v.replace("-", "+").replace("_", "/")]
            n, mean, h = len(codes), sum(codes) / max(len(codes), 1), sum(c >= k / 2 for c in codes)
            squares = sum(codes.count(c) ** 2 for c in set(codes))
            ok = False
            if n > 1 and 0 < h < n and len(set(codes)) > 1:
                f, mu = k - 1, 2 * h * (n - h) / n
                z = [(((squares * k / n - n) / f) ** (1 / 3) - (1 - 2 / (9 * f))) / math.sqrt(2 / (9 * f)) if squares * k / n >= n else -9.0]
                runs = 1 + sum((a >= k / 2) != (b >= k / 2) for a, b in zip(codes, codes[1:], strict=False))
                var = mu * (mu - 1) / (n - 1)
                z.append((runs - 1 - mu) / math.sqrt(var) if var > 0 else 9.0)
                z.append(sum((a - mean) * (b - mean) for a, b in zip(codes[1:], codes, strict=False)) / sum((c - mean) ** 2 for c in codes) * math.sqrt(n))
                ok = all(abs(x) < 3.2905 for x in z)
            found.append((d, m.start(), m.end(), max(0, min(400, math.floor(ratio))), ok))
    cut = 401
    for t in range(400, 0, -1):
        above = sum(e >= t for *_, e, _ in found)
        if above and math.exp(-t) <= rate * above / len(found):
            cut = t
    return {d: {(s, e) for i, s, e, x, ok in found if i == d and ok and x >= cut} for d in range(len(texts))}


def test_secret_added_spans(odd, real, secrets):
    for docs in (odd, real, secrets):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        want = brute_added([t for _, t in rows])
        got = secret_scan.scan(docs).collect()
        found = Counter((r.doc_id, tuple((s.start, s.stop) for s in r.spans if s.kind_no == 3)) for r in got)
        assert found == Counter((d, tuple(sorted(want[i]))) for i, (d, _) in enumerate(rows))
    assert sum(len(v) for v in want.values()) >= 27


def test_secret_scan_of_a_text_of_keys(spark):
    """Two megabytes of keys in one text: the work grows with the length of the text alone."""
    rng = random.Random(7)
    text = "\n".join("".join(rng.choices("0123456789abcdef", k=40)) + (" token=abcdef" if i % 9 == 0 else "") for i in range(50_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.monotonic()
    got = secret_scan.digest(secret_scan.scan(docs)).first()
    assert (got.n_hex, got.n_assign) == (50_000, 5_556) and time.monotonic() - began < 40
    clean = secret_scan.redact(docs).first().text
    assert clean.count("[secret]") == 55_556 and len(clean) == len("\n".join("[secret]" + (" [secret]" if i % 9 == 0 else "") for i in range(50_000)))


def test_secret_battery_finds_random_keys_alone(secrets):
    got = {r.doc_id: r.spans for r in secret_scan.digest(secret_scan.scan(secrets)).collect()}
    assert sum("random:" in got[i] for i in range(30)) >= 27
    assert not any("random:" in got[i] for i in [*range(300, 500), 600, 601])


def test_redact(odd, none, real, secrets):
    for docs in (odd, real, secrets):
        spans = {r.doc_id: [tuple(s) for s in r.spans] for r in secret_scan.scan(docs).collect()}
        got = secret_scan.redact(docs)
        assert got.columns == docs.columns and got.count() == docs.count()
        texts = {r.doc_id: r.text for r in docs.collect()}
        for r in got.collect():
            text, out, at = texts[r.doc_id], "", 0
            for s, _, e in spans[r.doc_id]:
                if s >= at:
                    out += text[at:s] + "[secret]"
                at = max(at, e)
            assert r.text == (None if text is None else out + text[at:])
    assert secret_scan.redact(none).count() == 0


def brute_targets(sizes, weights=(1, 2, 3), cap=3.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s] + 1e-9]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


def test_mixing(spark, odd, none, real):
    lop = spark.createDataFrame([(i, "w " * (i % 7), "big" if i % 3 else f"s{i % 5}") for i in range(400)], "doc_id long, text string, source string")
    for docs in (odd, real, lop):
        got = mixing.mix(docs).collect()
        assert len(got) == docs.count()
        sizes = Counter()
        for r in docs.collect():
            sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        want = brute_targets(sizes)
        taken = Counter()
        for r in got:
            assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
            assert 0 <= r.taken <= 3 * r.size
            taken[r.source] += r.taken
        assert all(taken[s] == int(want[s] + 1e-9) for s in sizes)
        for per in (3, 50):
            assert Counter(map(tuple, mixing.mix(docs, rows_per_range=per).collect())) == Counter(map(tuple, got))
        mixed = mixing.mixed(docs)
        assert mixed.columns == [*docs.columns, "size", "taken"]
        assert Counter(r.taken for r in mixed.collect()) == Counter(r.taken for r in got if r.taken)
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0


def test_mixing_ignores_clashing_names(odd):
    assert mixing.mixed(odd.withColumn("size", F.lit(1)).withColumn("taken", F.lit(2))).filter("taken = 2 AND size = 1").count() == 0
    names = [*(f"m_{n}" for n in ("id", "source", "size", "key", "part", "taken")), *(f"c_{n}" for n in ("source", "range", "size", "target", "epochs", "rest", "split"))]
    clashing = mixing.mixed(odd.withColumns({n: F.lit("own") for n in names}))
    assert clashing.columns == [*odd.columns, *names, "size", "taken"]
    assert {r[n] for r in clashing.collect() for n in names} == {"own"}
    assert Counter(r.taken for r in clashing.collect()) == Counter(r.taken for r in mixing.mixed(odd).collect())


def test_mixing_spreads_rows_of_no_id(spark):
    docs = spark.createDataFrame([(None, f"word {i} {'more ' * (i % 5)}", "a") for i in range(300)], "doc_id long, text string, source string")
    assert mixing.keyed(docs).select("m_key").distinct().count() == 300
    assert sum(r.taken for r in mixing.mix(docs).collect()) == sum(r.size for r in mixing.mix(docs).collect())
