import random
import re

import pytest

from surveyscore.llm import secrets as sc


def brute(text):
    """Base spans by the definition, one position after another."""
    out = []
    patterns = {
        "assign": (r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 6),
        "access": (r"AKIA[A-Z0-9]+", 0, 20), "hex": (r"[0-9a-f]+", 0, 24),
    }
    for order, (kind, (pattern, group, least)) in enumerate(patterns.items()):
        at = 0
        while m := re.compile(pattern).search(text, at):
            if len(m[group]) >= least:
                out.append((m.start(), order, kind, m.end()))
            at = m.end()
    return [(k, a, b) for a, _, k, b in sorted(out)]


HEX = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
TEXTS = ["", "token = abc", "TOKEN: abcdef", "api_key='x.y/z+1=' apikey=123456", "Passwd\" : \"hunter2hunter2", "ſecret=abcdefgh",
         "toKen=abcdefgh", "secret = token = abcdefgh", f"x {HEX} y{HEX[:23]}", "AKIA" + "Z" * 15 + " AKIA" + "B7" * 8, f"AKIAAKIA{HEX.upper()}",
         f"token={HEX}", "é漢😀 password=pässwörd password=ok12345é", "0" * 5000, f"api_key: {'A1b2' * 3000}", "secret=\tabcdef", "secret  =  abcdef"]


def test_base_spans_equal_the_definition():
    rnd = random.Random(9)
    letters = ["token", "secret", "api_key", "=", ":", " ", "'", '"', "AKIA", "A", "9", "f", "0", "é", ".", "\n", "passwd", "abcdef", HEX]
    texts = TEXTS + ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 25))) for _ in range(3000)]
    for t in texts:
        assert [s for s in sc.find_spans(t) if s[0] != sc.ADDED] == brute(t), t


def test_random_runs_are_found_and_structured_ones_are_not():
    rnd = random.Random(11)
    alphabets = {name: letters for name, letters, _ in sc.ENCODINGS}
    hits = sum(bool(sc.random_spans("".join(rnd.choice(alphabets["base62"]) for _ in range(40)), [])) for _ in range(300))
    assert hits > 270
    plain = ["internationalization_of_things_2024", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa1111", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghij0123456789",
             "https//example/path/to/Some/file2024/index", "thonerinthaterstheblendouthering", "1234567890123456789012345678901234567890",
             "A1A1A1A1A1A1A1A1A1A1A1A1A1A1A1", "the-quick-brown-fox-jumps-over-the-lazy-dog-2-times-or-More"]
    assert not [p for p in plain if sc.random_spans(p, [])]


def test_p_values_are_about_uniform_for_random_runs():
    import numpy as np

    rng = np.random.default_rng(3)
    for size in (16, 36, 64):
        draws = [rng.integers(0, size, 80) for _ in range(800)]
        for p in (lambda v: sc.p_uniform(v, size), lambda v: sc.p_runs(v, size), sc.p_serial):
            share = np.mean([p(v) < 0.1 for v in draws])
            assert 0.03 < share < 0.2


def test_false_discovery_control():
    assert sc.structured([], []) == []
    assert sc.structured([0.0005, 0.9], [30, 30]) == [True, False]
    assert sc.structured([0.02, 0.9, 0.8, 0.7], [30] * 4) == [False] * 4
    assert sc.structured([0.02, 0.9, 0.8, 0.7], [200, 10, 10, 10])[0]  # a long run may spend more of the rate


def test_fisher_against_its_definition():
    # chi-squared with 6 degrees of freedom at 12.592 leaves 5 %
    import math

    p = math.exp(-12.592 / 6)
    assert abs(sc.fisher([p, p, p]) - 0.05) < 1e-3


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 0) for i, t in rows], "doc_id long, text string, spans string, id int")


def test_operator_edge_cases(spark):
    rows = [(1, None), (None, f"token={HEX}"), (2, ""), (3, f"token={HEX}"), (3, f"token={HEX}")]
    got = {(r.doc_id, len(r.spans)) for r in sc.find_secrets(frame(spark, rows)).collect()}
    assert got == {(1, 0), (None, 2), (2, 0), (3, 2)}
    assert sc.find_secrets(frame(spark, [])).count() == 0


def test_redaction_masks_each_secret_once_and_keeps_rows(spark):
    rows = [(1, f"a token={HEX} b"), (2, None), (3, "plain"), (4, f"é {HEX} x {HEX}")]
    out = sc.redact(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "spans", "id"]
    assert {r.doc_id: r.text for r in out.collect()} == {1: "a <secret> b", 2: None, 3: "plain", 4: "é <secret> x <secret>"}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_query_on_the_whole_table(spark, sf):
    import hashlib

    from surveyscore.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op6_secret_scan"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        want = brute(r.text or "")
        row = got.pop(r.doc_id)
        assert row.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == x for k, _, _ in want) for x in ("assign", "access", "hex")]
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(row.spans.split(","))
    assert not got
