import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from filigree.llm import names as N


@pytest.mark.parametrize(
    "name,parsed",
    [
        ("Mr. Daniel J. Rasoswell Sr.", ("full", "rasoswell", "daniel", "sr")), ("RASOSWELL, SR., DAN J.", ("full", "rasoswell", "dan", "sr")), ("Harshaw III, Marta R", ("full", "harshaw", "marta", "3")),
        ("M. R. Harshaw, CPA", ("initial", "harshaw", "m", "")), ("Dr. Harshaw", ("surname", "harshaw", "", "")), ("Edward R. Orrwell Quilley", ("full", "orrwellquillei", "edward", "")),
        ("Orrwell-Quilley, Edward", ("full", "orrwellquillei", "edward", "")), ("Unknown", None), ("N/A", None), ("the Company", None), (None, None), ("  ", None), ("1234", None), ("Mr.", None),
        ("Alexandra Istishlow, Ph.D.", ("full", "istishlow", "alexandra", "")),
    ],
)
def test_parse(name, parsed):
    assert N.parse(name) == parsed


def test_organisations():
    forms = [N.parse(x) for x in ("Selwell & Tolaxbane Transfer Corp", "SELWELL AND TOLAXBANE TRANSFER CORPORATION", "The Selwell + Tolaxbane Transfer, Corp.")]
    assert len(set(forms)) == 1 and forms[0][0] == "org" and forms[0][3] == "corp"
    assert N.parse("Ildeststead and Zellow Counsel, L.L.P.")[3] == "llp"


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_parse_never_fails(name):
    N.parse(name)


def _groups(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "id bigint, company string, names array<string>, date string, key string, label int")
    groups = {}
    for r in N.resolve(df).collect():
        groups.setdefault(r.entity, set()).add(r.id)
    return sorted(sorted(g) for g in groups.values())


def test_variants_of_one_person(spark):
    names = ["Daniel J. Rasoswell", "RASOSWELL, DAN J.", "Daniel Rasosewll", "Mr. Danny Rasoswell, CPA", "D. Rasoswell", "Dr. Rasoswell", "Daniel Ras0swell", "Danail Rasoswell"]
    rows = [(i, "c", [n], None) for i, n in enumerate(names)]
    assert _groups(spark, rows) == [list(range(len(names)))]


def test_companies_suffixes_and_given_names_keep_apart(spark):
    rows = [
        (1, "c", ["Tariq Coromkova Sr."], None), (2, "c", ["Coromkova, Jr., Tariq"], None), (3, "c", ["Tariq L. Coromkova, Sr"], None), (4, "d", ["Tariq Coromkova Sr."], None), (5, "c", ["Marta Coromkova"], None),
        (6, "c", ["Amara Coromkova"], None), (7, "c", ["Dr. Coromkova"], None), (8, None, ["Marta Coromkova"], None), (9, "c", None, None), (10, "c", [None, "", "Unknown"], None), (11, "c", ["Tariq Coromkova"], None),
    ]
    assert _groups(spark, rows) == [[1, 3], [2], [4], [5], [6], [7], [11]]


def test_a_suffix_left_out_and_dates(spark):
    rows = [(1, "c", ["Olga Yarberg III"], None), (2, "c", ["Olga M. Yarberg"], None), (3, "c", ["Steven Ildomric"], "2014-01-15"), (4, "c", ["Sara Ildomric"], "2009"), (5, "c", ["S. Ildomric"], "January 2014"), (6, "c", ["S. Ildomric"], None)]
    assert _groups(spark, rows) == [[1, 2], [3, 5], [4], [6]]


def test_aliases_join_different_surnames_and_rematch(spark):
    rows = [(1, "c", ["Katherine Jorishe"], None), (2, "c", ["Katherine Lanley-Zelson", "Katherine Jorishe"], None), (3, "c", ["Ms. Kate LanleyZelson"], None), (4, "c", ["K. Jorishe"], None), (5, "c", ["Lanley Zelson, K. T."], None)]
    assert _groups(spark, rows) == [[1, 2, 3, 4, 5]]


def test_repeated_rows_ties_and_empty(spark):
    assert _groups(spark, []) == []
    assert _groups(spark, [(1, "c", ["Ann Lee"], None), (1, "c", ["Ann Lee"], None), (2, "c", ["Ann Lee"], None)]) == [[1, 2]]
    assert _groups(spark, [(1, "c", ["x" * 5000 + " " + "y" * 3000], None)]) == [[1]]


def test_pairs(spark):
    ent = spark.createDataFrame([(1, 7), (2, 7), (3, 7), (4, 8)], "id bigint, entity bigint")
    assert sorted(tuple(r) for r in N.linked_pairs(ent).collect()) == [(1, 2), (1, 3), (2, 3)]


def test_a_merged_profile_is_blocked_by_all_it_holds(spark):
    """The date of one record and the spelling of another make a key that neither had."""
    rows = [(1, "c", ["Olga Petrova"], "2018-03-01"), (2, "c", ["Olga Petrova", "Olga Marsh"], None), (3, "c", ["O. Marsh"], "2018-03-01"), (4, "c", ["Oscar Marsh"], "2020-01-01")]
    assert _groups(spark, rows) == [[1, 2, 3], [4]]


def test_two_suffixes_that_meet_leave_the_rest_merged_in_every_company(spark):
    five = [["Ivan Petrov", "Ivan Marsh"], ["Ivan Petrov Jr."], ["Ivan Marsh Sr."], ["Ivan Marsh", "Ivan Q. Marsh"], ["Ivan Petrov", "Ivan Q. Petrov"]]
    rows = [(5 * c + i, f"c{c}", names, None) for c in range(20) for i, names in enumerate(five)]
    assert _groups(spark, rows) == sorted(g for c in range(20) for g in ([5 * c, 5 * c + 3, 5 * c + 4], [5 * c + 1], [5 * c + 2]))


def test_given_names_known_by_frequency(spark):
    rows = [(c, f"c{c}", [f"{g} Harwell"], None) for c in range(60) for g in ("Zelda",)]
    rows += [(100 + c, f"c{c}", ["Zelma Harwell"], None) for c in range(8)]  # as a name of its own, too rare beside the other
    rows += [(200 + c, f"d{c}", [g], None) for c, g in enumerate(["Brunhild Onder"] * 6 + ["Brunhilt Onder"] * 6)]
    rows += [(300, "e", ["Brunhild Onder"], None), (301, "e", ["Brunhilt Onder"], None)]
    df = spark.createDataFrame(rows, "id bigint, company string, names array<string>, date string")
    profiles = df.mapInArrow(N._profiles, f"id bigint, {N.PROFILE}")
    states = {r.given: r.state for r in N.given_states(profiles.drop("id")).collect()}
    assert states["zelda"] == N.KNOWN and states["zelma"] == N.KNOWN and states["brunhild"] == states["brunhilt"] == N.KNOWN
    few = df.where("id < 104 or id >= 200")
    states = {r.given: r.state for r in N.given_states(few.mapInArrow(N._profiles, f"id bigint, {N.PROFILE}").drop("id")).collect()}
    assert states["zelma"] == N.MISTYPED
    groups = {r.id: r.entity for r in N.resolve(few).collect()}
    assert groups[300] != groups[301] and groups[0] == groups[100]


def test_pairs_of_a_large_entity_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "PAIR_BLOCK", 7)
    ent = spark.createDataFrame([(i, i // 40) for i in range(80)], "id bigint, entity bigint")
    assert N.linked_pairs(ent).count() == 2 * 40 * 39 // 2


def test_rounds_of_companies_write_no_tables(spark, monkeypatch):
    """Each round was 10 jobs or so on the driver, which ran out of memory with them."""
    written = []
    monkeypatch.setattr(N, "stage", lambda df, *, label="stage", own=N.stage: written.append(label) or own(df, label=label))
    assert _groups(spark, [(1, "c", ["Ann Lee"], None)]) == [[1]]
    once = written[:]
    written.clear()
    rows = [(1, "c", ["Katherine Jorishe"], None), (2, "c", ["Katherine Lanley-Zelson", "Katherine Jorishe"], None), (3, "c", ["Ms. Kate LanleyZelson"], None), (4, "c", ["K. Jorishe"], None), (5, "c", ["Lanley Zelson, K. T."], None)]
    assert _groups(spark, rows) == [[1, 2, 3, 4, 5]] and written == once


MET_BEFORE = [(1, "c", ["Ivan Petrov", "Ivan Marsh"], None), (2, "c", ["Ivan Petrov Jr."], None), (3, "c", ["Ivan Marsh Sr."], None), (4, "c", ["Ivan Marhs Sr."], None)]


def test_a_suffix_met_in_an_earlier_round_counts(spark):
    """The two Sr. merge first; the Jr. still keeps the one without a suffix from following them."""
    assert _groups(spark, MET_BEFORE) == [[1], [2], [3, 4]]


def test_large_companies_by_rounds_agree_with_tasks(spark):
    rng = random.Random(5)
    rows = MET_BEFORE[:]
    for i in range(5, 150):
        given, last = rng.choice("Ivan Olga Robert Rob Stephen Steven Brunhild".split()), rng.choice("Petrov Marsh Harwell Orrwell-Quilley".split())
        if rng.random() < 0.4:
            at = rng.randrange(1, len(last))
            last = last[:at] + last[at + 1 :]
        given = rng.choice([given, given, given[0] + ".", "Dr."])
        spelled = [f"{given} {last}{rng.choice(['', '', '', ' Jr.', ' Sr.'])}"] + [f"{given} Zelson"] * (rng.random() < 0.1)
        if rng.random() < 0.1:
            spelled = [f"{last} & Zelson {rng.choice(['Audit', 'Trust'])}{rng.choice(['', ' LLP', ' Corp'])}"]
        rows.append((i, rng.choice("cccde"), spelled, rng.choice([None, None, "2014", "2014-03", "2015-01-02"])))
    df = spark.createDataFrame(rows, "id bigint, company string, names array<string>, date string")
    sizes = Counter(r[1] for r in rows)
    within = sorted(map(tuple, N.resolve(df).collect()))
    assert sorted(map(tuple, N.resolve(df, most=sizes["d"]).collect())) == within and sizes["c"] > sizes["d"]
    assert 10 < len({e for _, e in within}) < 100
