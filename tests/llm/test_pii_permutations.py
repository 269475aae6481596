"""Pseudonyms against an independent Feistel network, and one to one over whole sets."""

import datetime as dt
import hashlib
import itertools
import re

from pyspark.sql import functions as F

from martlet.llm import pii


def network(a, b, size_a, size_b, key, tweak):
    for i in range(pii.ROUNDS):
        def f(other):
            return int(hashlib.sha256(f"{key}|{tweak}|{i}|{other}".encode()).hexdigest()[:15], 16)

        if i % 2 == 0:
            a = (a + f(b)) % size_a
        else:
            b = (b + f(a)) % size_b
    return a, b


def column(spark, values, made):
    rows = spark.createDataFrame([(v,) for v in values], "v string").select("v", made(F.col("v")).alias("n"))
    return {r.v: r.n for r in rows.collect()}


def test_digits_equal_an_independent_network(spark):
    values = ["7", "42", "123", "4111111111111111", "0" * 18, "123456789012345678901234", "9" * 30]
    got = column(spark, values, lambda v: pii.permute_digits(v, "secret", "iban"))
    for v in values:
        u = len(v) // 2
        a, b = network(int(v[:u] or 0), int(v[u:]), 10**u, 10 ** (len(v) - u), "secret", f"iban|{len(v)}|")
        assert got[v] == (f"{a:0{u}d}" if u else "") + f"{b:0{len(v) - u}d}"


def spellings(years):
    for y in years:
        day = dt.date(y, 1, 1)
        while day.year == y:
            d, m = day.day, day.month
            for x in {str(d), f"{d:02d}"}:
                for z in {str(m), f"{m:02d}"}:
                    yield f"{x}/{z}/{y}"
                    yield f"{z}/{x}/{y}"
            day += dt.timedelta(days=1)


def readable(text, order):
    parts = [int(x) for x in re.split("[/.]", text)]
    try:
        return dt.date(parts[2], *(parts[1::-1] if order == "dmy" else parts[:2]))
    except ValueError:
        return None


def test_all_date_strings_of_a_century_are_permuted(spark):
    """One to one over every spelling of every day; each stays in its form and is a date."""
    for years in (range(1900, 2000), range(2000, 2100)):
        values = sorted(set(spellings(years)))
        got = column(spark, values, lambda v: pii._date(v, "k"))
        assert len(got) == len(values) and sorted(got.values()) == values
        for v, n in itertools.islice(got.items(), 0, None, 97):
            assert [len(x) for x in n.split("/")] == [len(x) for x in v.split("/")]
            for order in ("dmy", "mdy"):
                assert (readable(v, order) is None) == (readable(n, order) is None)
        assert sum(v == n for v, n in got.items()) < 0.2 * len(values)


def test_no_date_stays_as_it_is(spark):
    bad = ["31/02/2020", "29/2/2021", "0/5/2020", "13/13/2020", "32/1/2020", "31.04.2020", "4.31.2020", "00.00.2020", "30/2/2020"]
    assert set(column(spark, bad, lambda v: pii._date(v, "k")).values()) == {None}


def test_phones_keep_what_makes_them_valid(spark):
    values = [f"({a}) {e}-{n:04d}" for a in (212, 415, 907) for e in (255, 512, 988) for n in range(0, 10_000, 37)]
    got = column(spark, values, lambda v: pii._phone(v, "k"))
    assert len(set(got.values())) == len(values)
    assert all(re.fullmatch(r"\([2-9]\d\d\) [2-9]\d\d-\d{4}", n) for n in got.values())
    other = column(spark, ["+44 20 7946 0958", "+49 30 1234567"], lambda v: pii._phone(v, "k"))
    assert other["+44 20 7946 0958"].startswith("+44 2") and other["+49 30 1234567"].startswith("+49 3")


def test_whole_iban_is_permuted(spark):
    iban = "PL61109010140000071219812874"
    new = column(spark, [iban], lambda v: pii._iban(v, "k"))[iban]
    turned = new[4:] + new[:4]
    assert int("".join(str(int(c, 36)) for c in turned)) % 97 == 1 and new[4:8] != iban[4:8] and len(new) == len(iban)
