"""Seeded random strings: native cleansers vs plain-Python statements of the rules."""

import random

from pyspark.sql import functions as F

from playmart.functions import text

TOKENS = ["省", "市", "自治区", "a", "b", "《", "》", "\n", "[", "]", ",", "2", "8", ".", "0", "-", "x", "e", "5"]


def random_strings(n=600, seed=17):
    rnd = random.Random(seed)
    out = [None, ""]
    for _ in range(n):
        out.append("".join(rnd.choice(TOKENS) for _ in range(rnd.randint(0, 12))))
    return out


def evaluate(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[1] for r in df.select("i", fn(F.col("s"))).orderBy("i").collect()]


def py_album(s):
    if s is None:
        return ""
    i, j = s.find("《"), s.rfind("》")
    return s[i:j + 1] if i >= 0 and j > i else ""


def _java_double(t):
    t = t.strip()
    if not t or t.lower().lstrip("+-") in ("nan", "infinity"):
        raise ValueError(t)
    return float(t)


def py_int_list(s):
    if s is None or "[" not in s:
        return []
    body = s.strip()
    body = body[1:] if body.startswith("[") else body
    body = body[:-1] if body.endswith("]") else body
    out = []
    for part in body.split(","):
        try:
            v = _java_double(part)
        except ValueError:
            break
        out.append(max(min(int(v), 2147483647), -2147483648))
    return out


def _marker(s):
    for m in ("自治区", "省", "市"):
        if m in s:
            return s.index(m)
    return -1


def _cut(s, begin, end):
    if begin < 0 or end > len(s) or begin > end:
        return ""
    return s[begin:end]


def py_province(s):
    if not s:
        return ""
    p = _marker(s)
    return _cut(s, 0, p)


def py_city(s):
    if not s:
        return ""
    p, m = _marker(s), s.find("市")
    if "省" in s and "市" in s:
        return _cut(s, p + 1, m)
    if "自治区" in s and "市" in s:
        return _cut(s, p + 3, m)
    if "市" in s:
        return _cut(s, 0, p)
    return ""


def test_album_random(spark):
    vals = random_strings()
    assert evaluate(spark, vals, text.album) == [py_album(v) for v in vals]


def test_int_list_random(spark):
    vals = random_strings(seed=5) + ["[1e10,2]", "[-1e12]", "[2.9, 3]"]
    assert evaluate(spark, vals, text.int_list) == [py_int_list(v) for v in vals]


def test_province_city_random(spark):
    vals = random_strings(seed=9)
    assert evaluate(spark, vals, text.province) == [py_province(v) for v in vals]
    assert evaluate(spark, vals, text.city) == [py_city(v) for v in vals]
