from __future__ import annotations

import random
import re

from llm_data import empty_docs, messy_docs, words
from tally.llm import license_scan as L


def brute(text, threshold=L.THRESHOLD):
    """Every run of words against every template, one by one."""
    w = re.findall(r"[^\W_]+", (text or "").lower())
    hits = []
    for name, template in L.TEMPLATES:
        t = L.plain_words(template)
        b, n, best = set(L.bigram_set(t)), min(len(t), len(w)), None
        for at in range(len(w) - n + 1) if n > 1 else ():
            a = set(L.bigram_set(w[at:at + n]))
            dice = 2.0 * len(a & b) / (len(a) + len(b))
            if dice >= threshold and (best is None or dice > best[0]):
                best = (dice, name, at, at + n - 1)
        if best:
            hits.append(best)
    hits = [h for h in hits if not any(g[1] != h[1] and (-g[0], g[1]) < (-h[0], h[1]) and g[2] < h[3] and h[2] < g[3]
                                       for g in hits)]
    if not hits:
        return None, None, ""
    dice, name = min((-h[0], h[1]) for h in hits)
    return name, -dice, ",".join(sorted({h[1] for h in hits}))


def found(spark, texts):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, license string")
    return [(r["license"], r["dice"], r["licenses"]) for r in L.scan_licenses(docs).orderBy("doc_id").collect()]


def comment(text, mark, width=12):
    w = text.split()
    return "\n".join(f"{mark} " + " ".join(w[i:i + width]) for i in range(0, len(w), width))


def test_notices_in_code_comments_prose_and_short_forms(spark):
    full = {name: max((t for n, t in L.TEMPLATES if n == name), key=len) for name in ("MIT", "Apache-2.0", "GPL-3.0")}
    code = "\nimport os\n\ndef main():\n    return os.getcwd()\n" * 4
    mit = re.split(r"(?<=conditions:)|(?<=Software\.)", " ".join(full["MIT"].split()))
    texts = [
        "/*\n * Copyright 2020 A. Person\n *\n" + "\n *\n".join(comment(p, " *") for p in mit if p.strip()) + "\n */" + code,
        comment(full["Apache-2.0"], "#") + code,
        comment(full["GPL-3.0"], "//") + "\n//\n" + code,
        words(random.Random(1), 80) + ". This work is licensed under a Creative Commons Attribution 4.0 International License, "
        "as are its parts. " + words(random.Random(2), 80),
        "#!/bin/sh\n# SPDX-License-Identifier: MIT\necho x",
        "the code is licensed under the MIT license, the text is not",
        "This work is licensed under the GNU General Public License, version 2.\n" + words(random.Random(3), 50),
        "we exchange a license for a permit, and the software is warm",
    ]
    got = found(spark, texts)
    assert [g[2] for g in got] == ["MIT", "Apache-2.0", "GPL-3.0", "CC-BY-4.0", "MIT", "MIT", "GPL-2.0", ""]
    assert got == [brute(t) for t in texts]


def test_a_notice_in_a_very_long_text(spark):
    long = words(random.Random(4), 40_000)
    text = long + " " + L.TEMPLATES[1][1] + " " + long
    assert found(spark, [text, long]) == [("Apache-2.0", 1.0, "Apache-2.0"), (None, None, "")]


def test_texts_equal_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i, (_, t) in enumerate(L.TEMPLATES):
        flat = " ".join(t.split())
        w = flat.split()
        rows += [(words(rng, 30) + "\n" + flat + "\n" + words(rng, 9)), flat.upper(), "\n\n".join([words(rng, 5), t, "x"]),
                 " ".join(w[:-1]), " ".join(w[:len(w) // 2]), " ".join(w + w), flat.replace(" ", "_-_"),
                 flat + "\n" + L.TEMPLATES[(i + 3) % len(L.TEMPLATES)][1], " ".join(x for x in w if rng.random() > 0.08)]
    rows += ["license", "", None, "the mit license", words(rng, 3000) + " license"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "doc_id bigint, text string, license string")
    got = {r["doc_id"]: (r["license"], r["dice"], r["licenses"]) for r in L.scan_licenses(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(rows)}
    assert sum(v[0] is not None for v in got.values()) > 100


def test_messy_and_empty(spark):
    assert L.scan_licenses(messy_docs(spark)).count() == messy_docs(spark).count()
    assert L.scan_licenses(empty_docs(spark)).count() == 0
