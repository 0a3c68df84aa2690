"""Line dedup: lines that recur below the bar of templates, digit fields, and large leaves."""

import random

from brute import line_templates

from dockstat.llm import linededup

WORDS = [a + b for a in "bcdfghklmnprst" for b in ("a", "e", "ion", "ou", "er", "ant", "ish")]


def found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {(r.doc_id, r.line_no): (r.n_docs, r.dropped) for r in linededup.recurring_lines(docs).collect()}


def own(rnd):
    return " ".join(rnd.choice(WORDS) for _ in range(15))


def test_whole_lines_recur_from_two_documents_on(spark):
    rnd = random.Random(3)
    long, numbered = own(rnd), "The order {} was sent to its new owner on {}"
    rows = [(20, own(rnd) + "\n" + long), (5268, long.upper() + "\n" + own(rnd)),
            (31, numbered.format(7, "2024-01-01")), (32, own(rnd) + "\n" + numbered.format(8, "2024-02-01")),
            (33, own(rnd) + "\n" + numbered.format(9, "2025-02-01")),
            (40, "just too short"), (41, "just too short"),                         # may be chance
            (50, long + " and more\n" + own(rnd)), (51, "x " + long)]                # not the same line
    assert found(spark, rows) == {(20, 1): (2, False), (5268, 0): (2, True), (31, 0): (3, False), (32, 1): (3, True),
                                  (33, 1): (3, True)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text for r in linededup.drop_recurring_lines(docs).collect()}
    assert left[20] == rows[0][1] and left[5268] == rows[1][1].split("\n")[1] and left[33] == rows[4][1].split("\n")[0]


def test_fields_stay_variable_however_many_documents_have_a_value(spark):
    rnd = random.Random(5)
    for per_value in (2, 30):                    # 24 names: below and above the bar of ten documents each
        rows = [(i, f"Report filed by {WORDS[i % 24]} for the {WORDS[40 + i // 24 % 24]} office today again")
                for i in range(24 * per_value)]
        rows += [(5000 + i, "Report filed by " + own(rnd)) for i in range(20)]
        rows += [(6000, "\n".join(f"Report filed by {WORDS[0]} for the {w} office today again" for w in WORDS))]
        got = found(spark, rows)
        assert len(got) == 24 * per_value + len(WORDS)
        assert set(got.values()) == {(24 * per_value + 1, False), (24 * per_value + 1, True)}
        assert not got[0, 0][1] and sum(not dropped for _, dropped in got.values()) == 1


def test_a_small_template_beside_a_large_one(spark):
    rows = [(i, f"This page was last changed on some day by {WORDS[i % 90]}") for i in range(900)]
    rows += [(2000 + i, f"This page was never seen by anyone but our {WORDS[i]}") for i in range(12)]
    got = found(spark, rows)
    assert {n for (d, _), (n, _) in got.items() if d < 2000} == {900}
    assert {n for (d, _), (n, _) in got.items() if d >= 2000} == {12} and len(got) == 912


def test_digit_fields_do_not_count_against_a_template(spark):
    rnd = random.Random(7)
    rows = [(i, f"Page {i} of 12\n2024-01-{i:02} 12:00:{i:02} INFO user {i} logged in from 10.0.0.{i}\n"
                f"Order {i} of {i} items for {WORDS[i]} was sent at {i}:30") for i in range(60)]
    rows += [(100 + i, f"Height {i} cm") for i in range(9)]                          # too few documents
    rows += [(200 + i, f"{i} {i} total") for i in range(60)]                         # one token is no template
    rows += [(300 + i, "Order 7 of 9 " + " ".join(rnd.choice(WORDS) for _ in range(6))) for i in range(40)]
    assert found(spark, rows) == {(d, i): (60, d > 0) for d in range(60) for i in range(3)}


def test_short_lines_take_part_if_asked(spark):
    rows = [(i, f"Menu\nRead more\n{i}\nword{i} " + WORDS[i]) for i in range(12)] + [(20, "Menu"), (21, "once")]
    assert found(spark, rows) == {}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.line_no): (r.n_docs, r.dropped) for r in linededup.recurring_lines(docs, min_tokens=1).collect()}
    assert got == line_templates(rows, min_tokens=1)
    assert got == {(i, 0): (13, i > 0) for i in (*range(12), 20)} | {(i, 1): (12, i > 0) for i in range(12)}


def test_texts_of_one_document_lose_their_own_lines(spark):
    rnd = random.Random(8)
    line, other = own(rnd), own(rnd)
    rows = [(1, line), (2, line + "\n" + other), (2, other + " x\n" + line), (2, other + " x\n" + line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.text for r in linededup.drop_recurring_lines(docs).collect()) == sorted([line, other, other + " x", other + " x"])


def test_groups_count_as_one_document(spark):
    rnd = random.Random(6)
    a, b = own(rnd), own(rnd)
    rows = [(1, a + "\n" + own(rnd)), (2, a + "\n" + b), (3, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = spark.createDataFrame([(2, 1)], "doc_id long, unit long")
    got = {(r.doc_id, r.line_no): (r.n_docs, r.dropped) for r in linededup.recurring_lines(docs, groups=groups).collect()}
    assert got == {(2, 1): (2, False), (3, 0): (2, True)} == line_templates(rows, units={2: 1})
