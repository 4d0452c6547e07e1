import math
import random
import string

import pytest
from pyspark.sql import functions as F

from siltstone.functions import estimators, hashing, text, vectors


def one(spark, column, **values):
    frame = spark.range(1)
    for name, value in values.items():
        frame = frame.withColumn(name, value if hasattr(value, "_jc") else F.lit(value))
    return frame.select(column).first()[0]


def number(value):
    return int.from_bytes(value.encode("utf-8"), "big")


def zeros(h):
    digits = format(h, "b").zfill(20)
    return len(digits) - len(digits.rstrip("0"))


WORDS = ["a", "ab", "abc", "abcd", "éa", "Zürich", "東京", "🙂 smile", "x" * 300, " ", "\x00a", "0"]


def test_text_mod_equals_big_integers(spark):
    generator = random.Random(1)
    words = WORDS + [
        "".join(generator.choices(string.printable + "äöüéß東", k=generator.randint(1, 40)))
        for _ in range(200)
    ]
    frame = spark.createDataFrame([(w,) for w in words], "w string")
    rows = frame.select(
        "w",
        hashing.text_mod("w", hashing.BLOOM_P).alias("b"),
        hashing.text_mod("w", hashing.FM_P).alias("f"),
    ).collect()
    for row in rows:
        assert row.b == number(row.w) % hashing.BLOOM_P
        assert row.f == number(row.w) % hashing.FM_P
    assert one(spark, hashing.text_mod("w", hashing.BLOOM_P), w="éa") == 12822881


def test_text_mod_of_long_texts(spark):
    """The work grows with the length: 400 kB would take minutes if it grew with its square."""
    texts = ["x" * 400_000, "äb" * 100_000, *["y" * n for n in range(1, 60)]]
    frame = spark.createDataFrame([(t,) for t in texts], "w string")
    rows = frame.select("w", hashing.text_mod("w", hashing.FM_P).alias("f")).collect()
    assert all(row.f == number(row.w) % hashing.FM_P for row in rows)


def test_text_mod_of_nothing(spark):
    assert one(spark, hashing.text_mod("w", 97), w="") is None
    assert one(spark, hashing.text_mod("w", 97), w=F.lit(None).cast("string")) is None


def test_bloom_positions(spark):
    for word in WORDS:
        positions = F.expr("array(" + ", ".join(hashing.bloom_positions_of("x")) + ")")
        got = one(spark, positions, w=word, x=hashing.text_mod("w", hashing.BLOOM_P))
        x = number(word)
        assert got == [((a * x + 83) % 233333333333) % 5000 for a in (83, 96, 44, 82, 25, 5, 101)]
    with pytest.raises(ValueError):
        hashing.bloom_positions_of("w", hashes=0)


def test_fm_constants_are_the_seeded_draws():
    generator = random.Random(666)
    top = 2**63 - 1
    a = generator.sample(range(1, top - 1), 12)
    b = generator.sample(range(2, top - 1), 12)
    assert tuple(v % hashing.FM_P for v in a) == hashing.FM_A
    assert tuple(v % hashing.FM_P for v in b) == hashing.FM_B
    assert tuple(random.Random(666).sample(range(12), 3)) == estimators.START_POSITIONS


def test_trailing_zeros(spark):
    values = [0, 1, 2, 3, 8, 2**19, 2**20, 2**27, 12345, 233333332]
    frame = spark.createDataFrame([(v,) for v in values], "v bigint")
    rows = frame.select("v", hashing.trailing_zeros("v").alias("z"),
                        hashing.binary_text(F.col("v")).alias("t")).collect()
    assert [r.z for r in rows] == [zeros(v) for v in values]
    assert [r.t for r in rows] == [format(v, "b").zfill(20) for v in values]


def test_fm_trailing_zeros(spark):
    for word in WORDS:
        columns = F.array(*hashing.fm_trailing_zeros("x"))
        got = one(spark, columns, w=word, x=hashing.text_mod("w", hashing.FM_P))
        x = number(word)
        assert got == [
            zeros((a * x + b) % 233333333) for a, b in zip(hashing.FM_A, hashing.FM_B)
        ]


def test_partition_codes(spark):
    import binascii

    assert one(spark, hashing.crc_of_first(F.col("k")), k="été") == binascii.crc32("é".encode())
    assert one(spark, hashing.crc_of_first(F.col("k")), k="") == binascii.crc32(b"")
    assert one(spark, hashing.code_of_first(F.col("k")), k="été") == ord("é")


def test_tokens_and_punctuation(spark):
    assert one(spark, text.tokens(F.col("t")), t="A  b c\nd") == ["a", "", "b", "c\nd"]
    assert one(spark, text.strip_punctuation(F.col("t")), t="(a[b],c.!d?e:f;g)-'") == "abcdefg-'"
    assert one(spark, text.comma_list(F.col("t")), t=" A ,B,\tC D\n,") == ["A", "B", "C D", ""]


def test_in_year(spark):
    date = text.in_year(F.col("d"), "string", 2018)
    assert one(spark, date, d="2018-01-02 10:00:00") is True
    assert one(spark, date, d="2017-12-31") is False
    stamp = text.in_year(F.col("d"), "timestamp", 2018)
    assert one(spark, stamp, d=F.lit("2018-05-05").cast("timestamp")) is True


def test_distances(spark):
    a, b, sd = [F.array(*[F.lit(float(x)) for x in v]) for v in ([1, 2, 3], [4, 6, 3], [1, 2, 0])]
    assert one(spark, vectors.euclidean(a, b)) == 5.0
    assert one(spark, vectors.mahalanobis(a, b, sd)) == pytest.approx(math.sqrt(9 + 4))
    zero = F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0))
    assert one(spark, vectors.mahalanobis(a, a, zero)) == 0.0
    assert one(spark, vectors.mahalanobis(a, b, zero)) == math.inf


def test_vector_arithmetic(spark):
    a, b = F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(3.0), F.lit(5.0))
    assert one(spark, vectors.add(a, b)) == [4.0, 7.0]
    assert one(spark, vectors.scale(a, F.lit(0.5))) == [0.5, 1.0]
    assert one(spark, vectors.squares(b)) == [9.0, 25.0]
    # Rounding may put a negative number under the root.
    assert one(spark, vectors.deviation(F.array(F.lit(1.0)), F.array(F.lit(0.9999999)))) == [0.0]


def test_moments(spark):
    rows = [(0, [1.0, 10.0]), (0, [3.0, 10.0]), (1, [5.0, 5.0])]
    frame = spark.createDataFrame(rows, "c int, v array<double>")
    got = {r.c: r for r in vectors.moments(frame, "c", "v").collect()}
    assert (got[0].n, got[0].mean, got[0].mean_square) == (2, [2.0, 10.0], [5.0, 100.0])
    assert got[0].deviation == pytest.approx([1.0, 0.0])
    assert got[1].deviation == pytest.approx([0.0, 0.0])


def plain_kmeans_middle(values):
    """Written from the rule: freeze in order, stop at the first centroid that moved."""
    centre = [float(values[p]) for p in (7, 6, 10)]
    frozen = [False] * 3
    for _ in range(5):
        groups = [[], [], []]
        for v in values:
            gaps = [abs(c - v) for c in centre]
            groups[gaps.index(min(gaps))].append(v)
        before = list(centre)
        for g in range(3):
            if not frozen[g]:
                centre[g] = sum([centre[g]] + groups[g]) / (1 + len(groups[g]))
        for g in range(3):
            frozen[g] = round(before[g], 1) == round(centre[g], 1)
            if not frozen[g]:
                break
        else:
            break
    return int(sorted(sum(g) / max(len(g), 1) for g in groups)[1])


def test_kmeans_groups(spark):
    generator = random.Random(3)
    samples = [[float(2 ** generator.randint(0, 14)) for _ in range(12)] for _ in range(300)]
    samples += [[1.0] * 12, [1.0] * 11 + [1024.0], [float(2**i) for i in range(12)]]
    frame = spark.createDataFrame([(s,) for s in samples], "e array<double>")
    rows = frame.select(
        "e",
        estimators.middle_of_kmeans_groups("e").alias("k"),
        estimators.middle_of_fixed_groups("e").alias("f"),
    ).collect()
    for row in rows:
        assert row.k == plain_kmeans_middle(list(row.e))
        means = sorted(sum(row.e[i : i + 4]) / 4 for i in (0, 4, 8))
        assert row.f == int(means[1])


def test_nothing_is_left_of_punctuation(spark):
    for token, expected in (("?!", ""), ("", ""), ("a", "a"), (".a", "a"), ("\n", "\n")):
        assert one(spark, text.strip_punctuation(F.col("t")), t=token) == expected
