import hashlib
import re

from stintlab.llm import pii
from tests.llm.tables import ODD_ROWS, docs, with_extra_columns

# The plain patterns, as stated.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if holds(k, m.group())]


def test_base_spans_equal_the_plain_patterns(spark, rng):
    pieces = [
        "4111 1111 1111 1111", "4111-1111-1111-1112", "a@b.co", "x.y@z-1.com-@q.de", "1.2.3.4", "300.1.1.1", "+49 (0) 171-2345678",
        "1.2.3.4.5.6.7.8", "a@b.c-d_e@f.g", "0" * 40 + "1.2.3.4", "é😀", "+1((((2", "..@..", "12 34-56",
    ]
    texts = ["".join(rng.choice("0123456789 -.+@()aé😀_%") for _ in range(rng.randint(0, 50))) for _ in range(2000)]
    texts += [" ".join(rng.choice(pieces) for _ in range(rng.randint(1, 5))) for _ in range(500)]
    texts += ["1 " * 30_000, "a" * 50_000 + "@b.c", "5" * 40_000, "a@" * 20_000, "", None]
    table = docs(spark, list(enumerate(texts)))
    for r in pii.digest(pii.find_personal_data(table)).collect():
        want = plain_spans(texts[r["doc_id"]])
        joined = ",".join("%s:%d:%d" % s for s in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(s[0] == k for s in want) for k in PLAIN]
        assert r["spans"].startswith(joined)


def _giving_away(spark):
    """A nickname that stands beside one address only, in ever new sentences."""
    rows = [(i, f"note{i} about zanzibar mail a.b@example.com thing{i} more") for i in range(6)]
    rows += [(10 + i, f"note{i} about other things mail nobody thing{i} more") for i in range(60)]
    return docs(spark, rows)


def test_terms_that_give_an_entity_away_are_found(spark):
    found = pii.find_personal_data(_giving_away(spark)).collect()
    for r in found:
        terms = {(t["start"], t["end"], t["value"]) for t in r["terms"]}
        if r["doc_id"] < 10:
            text = f"note{r['doc_id']} about zanzibar mail a.b@example.com thing{r['doc_id']} more"
            assert (text.index("zanzibar"), text.index("zanzibar") + 8, "remove") in terms
            assert all(text[a:b] not in ("about", "mail", "more") for a, b, _ in terms)
        else:
            assert not terms


def test_copies_are_no_evidence(spark):
    rows = [(i, "about zanzibar mail a.b@example.com more") for i in range(6)] + [(9 + i, f"about other{i}") for i in range(30)]
    assert all(not r["terms"] for r in pii.find_personal_data(docs(spark, rows)).collect())


def test_sanitised_text(spark):
    found = pii.find_personal_data(_giving_away(spark).filter("doc_id <> 1")).filter("doc_id = 0")
    joined = found.join(_giving_away(spark).select("doc_id", "text"), "doc_id")
    (out,) = joined.select(pii.sanitise(joined["text"], joined["base"], joined["terms"]).alias("t")).collect()
    assert out["t"] == "note0 about  mail [email] thing0 more"


def test_awkward_rows_and_empty_table(spark):
    table = with_extra_columns(docs(spark, ODD_ROWS))
    assert pii.find_personal_data(table).count() == len(ODD_ROWS)
    assert pii.digest(pii.find_personal_data(table.limit(0))).count() == 0


def test_no_python_in_the_plan(spark):
    plan = pii.digest(pii.find_personal_data(_giving_away(spark)))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)
