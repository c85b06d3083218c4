"""Every run of 20 or more mixed characters is tested, whatever it is glued to."""

import random
import string

import pytest
from pyspark.sql import functions as F

from tablemill.llm.secrets import redact_secrets, with_randomness

LOWER, UPPER, DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
# What stands before the secret, its letters.
KINDS = {
    "key=value": ("session=", LOWER + UPPER + DIGITS),
    "two keys": ("a=b=", LOWER + UPPER + DIGITS),
    "base36 lower": ("", LOWER + DIGITS),
    "base36 upper": ("", UPPER + DIGITS),
    "base32 lower": ("", LOWER + "234567"),
    "prefix of a base64 secret": ("sk_live_", LOWER + UPPER + DIGITS + "+/"),
    "prefix of a base64url secret": ("path/", LOWER + UPPER + DIGITS + "-_"),
    "prefix of a base36 secret": ("sk_live_", LOWER + DIGITS),
}


def made(letters, n, rng):
    while True:
        out = "".join(rng.choices(letters, k=n))
        if all(any(c in out for c in kind) for kind in (LOWER, UPPER, DIGITS, "+/", "-_") if set(kind) & set(letters)):
            return out


@pytest.mark.parametrize("kind", KINDS)
def test_secrets_are_taken_out(spark, kind):
    before, letters = KINDS[kind]
    rng = random.Random(kind)
    secrets = [made(letters, 28, rng) for _ in range(100)]
    docs = spark.createDataFrame([(i, f"here it is {before}{s} and more", 0) for i, s in enumerate(secrets)], "doc_id long, text string, n_chars long")
    left = sum(secrets[r["doc_id"]] in r["text"] for r in redact_secrets(docs).collect())
    assert left <= 10


def test_every_mixed_run_has_a_p_value(spark):
    from tablemill.llm import secrets

    rng = random.Random(0)
    runs = ["".join(rng.choices(rng.choice([LOWER + DIGITS, UPPER + DIGITS, LOWER + UPPER, string.ascii_letters + DIGITS + "+/-_"]), k=rng.randint(20, 60))) for _ in range(300)]
    runs += ["550e8400-e29b-41d4-a716-446655440000", "Ab3/xY_9k-Qw+7Rt/2Vb_Nm4", "sk_live_a+b/c", "plainwordsonlywithoutanydigits"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(runs)], "i long, text string")
    tested = secrets._with_tokens(df, "text").select("i", F.explode("_token").alias("t")).select("i", F.col("t.found").alias("found"))
    rows = with_randomness(tested, "found").collect()
    assert all(r["p_random"] is not None for r in rows)
    mixed = {i for i, r in enumerate(runs) if len(r) >= 20 and sum(any(c in r for c in kind) for kind in (LOWER, UPPER, DIGITS)) >= 2}
    assert {r["i"] for r in rows} == mixed


def test_words_are_left(spark):
    text = "see https://example.org/articles/2024/some-title-of-a-long-page and getUserAccountInformationOfTheDay or the state-of-the-art-of-2024 x=y"
    docs = spark.createDataFrame([(i, f"{text} {i}", 0) for i in range(50)], "doc_id long, text string, n_chars long")
    assert [r["text"] for r in redact_secrets(docs).orderBy("doc_id").collect()] == [f"{text} {i}" for i in range(50)]
