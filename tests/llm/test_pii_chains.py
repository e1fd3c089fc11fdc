"""Identifiers that only found identifiers lead to."""

from visitry.llm import pii

#: National numbers stand after 'call me', as seeds do, and after 'Tel.:', where no seed stands.
CHAIN = [(k, f"please call me +49 30 55512{k:02d} or later today") for k in range(20)]
CHAIN += [(100 + k, f"please call me 030555{k}123 or later today") for k in range(4)]
CHAIN += [(200 + k, f"our office Tel.: 030555{k}123 in town") for k in range(4)] + [(300, "our office Tel.: 0771234567 in town")]


def test_two_hops(make):
    found = {r["doc_id"]: r for r in pii.span_digest(pii.extract_identifiers(make(CHAIN))).collect()}
    assert found[0]["n_phone"] == 1 and found[100]["spans"] == "phone:15:25"
    assert found[300]["spans"] == "phone:17:27" and found[300]["n_phone"] == 0
    texts = {r["doc_id"]: r["text"] for r in pii.redact(make(CHAIN)).collect()}
    assert texts[300] == "our office Tel.: <PHONE> in town" and texts[203] == "our office Tel.: <PHONE> in town"


def test_grouped_numbers(make):
    rows = [(k, f"please call me +49 30 55512{k:02d} or later today") for k in range(30)]
    grouped = ["030 555 1234", "(555) 123 4567", "030-555 1234", "030 (555) 1234", "030.555 1234"]
    rows += [(100 + k, f"please call me {g} or later today") for k, g in enumerate(grouped)]
    found = {r["doc_id"]: r for r in pii.span_digest(pii.extract_identifiers(make(rows))).collect()}
    texts = {r["doc_id"]: r["text"] for r in pii.redact(make(rows)).collect()}
    for k, g in enumerate(grouped):
        assert found[100 + k]["spans"] == f"phone:15:{15 + len(g)}" and texts[100 + k] == "please call me <PHONE> or later today"


def test_groups_of_long_runs():
    for t in ("1" * 300_000, "1 " * 100_000, "(" * 100_000 + "1", "1 2" * 50_000 + "a", "1a" * 100_000, "1)(" * 100_000):
        pii.other_words(t, [])
