"""Random tokens in the forms that hide them: assignments, addresses and paths."""

import base64
import hashlib

import pytest

from tamiz.llm import secrets


def secret(i):
    return base64.b64encode(hashlib.sha512(str(i).encode()).digest()).decode()


FORMS = {
    "env": ("AWS_ACCESS_CODE={}", lambda s: s.rstrip("=")),
    "padded": ("auth={}", lambda s: s),
    "url": ("see https://h.example/my_path/{}", lambda s: s.rstrip("=").replace("/", "_").replace("+", "-")),
    "query": ("https://h.example/my_path?x-y=1&auth={}&z=2", lambda s: s.rstrip("=").replace("/", "_").replace("+", "-")),
    "path": ("/home/some_user/cache-dir/{}/file", lambda s: s.rstrip("=").replace("/", "").replace("+", "")),
    "named": ("my_own_name_{}", lambda s: s.rstrip("=")),
}


@pytest.mark.parametrize("form", FORMS)
def test_hidden_tokens_are_found(spark, form):
    frame, write = FORMS[form]
    made = [(i, frame.format(write(secret(i)))) for i in range(60)]
    text = [(1000 + i, f"/usr/share/some_package-{i}/documentation-and-examples/read_me_first") for i in range(100)]
    df = spark.createDataFrame(made + text, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(df).collect()}
    assert not [i for i in got if i >= 1000 and got[i]]
    whole = 0
    for i, t in made:
        value = write(secret(i))
        at = t.index(value)
        whole += f"random:{at}:{at + len(value)}" in got[i].split(",")
    assert whole >= 45


def test_letters_alone_are_tested(spark):
    """A run without a digit or without a letter is a token as well."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("QwErTyUiOpAsDfGhJkLzXcVb 1234567890123456789012 KEY=v",)], "t string")
    got = df.select(secrets.candidates(F.col("t")).alias("c")).first()["c"]
    assert [x["value"] for x in got] == ["QwErTyUiOpAsDfGhJkLzXcVb", "1234567890123456789012"]
