"""Secret rules other than the three that come along."""

from __future__ import annotations

import re

from martkit.llm import secret_ledger


def test_secret_rules_of_others(spark):
    """Rules that end in a plus find all that their pattern and least length ask for."""
    rules = (
        secret_ledger.Rule("github", 1, "ghp_[A-Za-z0-9]+", 0, 40),
        secret_ledger.Rule("pairs", 1, "(?:ab)+", 0, 6),
        secret_ledger.Rule("either", 1, "key-[0-9]+|id-[a-z]+", 0, 8),
        secret_ledger.Rule("access_key", 1, "AKIA[A-Z0-9]+", 0, 20),
        *secret_ledger.RULES,
    )
    texts = ["x ghp_" + "Z" * 36 + " y", "ghp_" + "Z" * 35, "abababab, abab", "key-1234 id-abcde key-123 id-abc", "AKIA" + "Q" * 16, "f" * 24]
    versions = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    ledger = secret_ledger.update_ledger(versions, rules=rules).cache()
    got = {r.doc_id: [tuple(f) for f in r.findings] for r in secret_ledger.findings_by_path(versions, ledger, rules).collect()}
    for doc_id, text in enumerate(texts):
        want = sorted(
            (m.start(), k, rule.kind, m.end())
            for k, rule in enumerate(rules)
            for m in re.finditer(rule.pattern, text, re.A)
            if len(m.group(rule.group)) >= rule.least
        )
        assert got[doc_id] == [(kind, start, stop) for start, _, kind, stop in want]
    assert [len(got[i]) for i in range(5)] == [1, 0, 1, 2, 2]


def test_rules_that_look_around_and_odd_kinds(spark):
    rules = (
        secret_ledger.Rule("semi", 1, "ghp_[a-z0-9]+(?=;)", 0, 6),
        secret_ledger.Rule("mail@home", 2, "(?<=to:)([a-z]+)@x", 1, 3),
    )
    versions = spark.createDataFrame([(1, "x ghp_abcdef1; y ghp_zzz9 to:bob@x, by:ann@x to:al@x")], "doc_id bigint, text string")
    versions = versions.selectExpr("*", "'mine' AS blob", "7 AS findings", "'kept' AS given_blob")
    ledger = secret_ledger.update_ledger(versions, rules=rules).cache()
    (got,) = secret_ledger.findings_by_path(versions, ledger, rules).collect()
    assert [tuple(f) for f in got.findings] == [("semi", 2, 13), ("mail@home", 29, 34)]
    assert (got._given_blob, got.given_findings, got.given_blob) == ("mine", 7, "kept")


def test_every_load_scans_what_is_new(spark):
    """Loads that add rules, or repeat them, end with the findings of one load; each pair is scanned once."""
    texts = ["password = abcdef12", "AKIA" + "Q" * 16 + " " + "0f" * 12, None, "password = abcdef12", "plain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rules = secret_ledger.RULES
    want = sorted(map(tuple, secret_ledger.secret_digest(docs, [rules]).collect()))
    for loads in ([rules[:1], rules[:2], rules], [rules, rules], [rules[2:], rules]):
        assert sorted(map(tuple, secret_ledger.secret_digest(docs, loads).collect())) == want
    first = secret_ledger.update_ledger(docs.where("doc_id < 2"), rules=rules[:2]).cache()
    added = secret_ledger.update_ledger(docs, first, rules).collect()
    assert sorted(sorted(r.rules) for r in added) == [["access@1", "assign@1", "hex@1"]] * 2 + [["hex@1"]] * 2
