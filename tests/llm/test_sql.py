"""The registered queries against their SQL on odd tables."""

import duckdb
import numpy as np
import pytest

from kudosflow.llm import registry

RNG = np.random.default_rng(12)
WORDS = "the of und die le la river HOUSE garden, light. stone% #paper é ß window* -x x… ...".split()
TEXTS = [
    None,
    "",
    " \n\t\x0b ",
    "one",
    "One two THREE",
    "one two three",
    "one two three four",
    "IBAN DE89 3704 0044 0532 0130 00 is paid, GB82WEST12345698765432 too, DE89 3704 not",
    "my SSN is 123-45-6789, but 000-12-3456 is none and ssn 1-123-45-6789-1 x",
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" API_KEY=sk-4Gx9/aB+c2Z8y7X6w5V4u3T2== x',
    "sha 04dbebab91ab85687d33eeaaf9ac699e1188f962 key aaaaaaaaaaaaaaaaaaaaaaaaa1111111111a1 é",
    "é 4111 1111 1111 1111 é 4111-1111-1111-1112 5500005555555559",
    "a@b.co_d@e.f x..y@z-.q-.r @x.y a@b",
    "1.2.3.4.5.6.7.8 and 256.1.1.1 0001.02.003.0255 1.2.3",
    "+1 (415) 555-0100 +1 2 +49 30 1234567 890 12 +12345678901 +1()()2",
    "call me: +44 20 7946 0958\nmail: x@example.org\n" * 40,
    *(" ".join(RNG.choice(WORDS, 120)) for _ in range(6)),
    *("\n".join(" ".join(RNG.choice(WORDS, 9)) for _ in range(12)) for _ in range(4)),
    "\n".join(["the same line again"] * 30 + ["", " ", "another one"]),
    "a b c " * 40,
    "• x\n- y\n* z\n… \nend...\n\u2028 w\u00a0v",
    " ".join(RNG.choice(WORDS, 5_000)),
]
URLS = [
    None, "", "x", "http://", "http://NET/", "a://b.net?x", "http://x.example.NET/en/1",
    "https://example.net/EN/", "http://example.com/de/", "http://a.example.com/de", "://org/fr/",
    "http://É.org/fr/#", "http://u@x.org:80/fr/", "http://x.org/fr/://net/", "a\nb://c\nd.net/\n?",
]

ROLES = ["user", "assistant", "system", None, "tool", "[/ROLE] [TEXT] x"]
TURNS = [
    None, "", "ok", "</s>[INST] ok [/INST]", "<\\s> <\\\\/s> \\[INST] [\\INST]", "<<s> <<<SYS>><</SYS>>",
    " [/INST]\n[INST] ", "é\u2028\\", "<s", "/s>", "[", "\n</s>\n", "[ROLE] [TEXT] [/ROLE]\n",
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("odd")
    repeated = TEXTS + [text and text.replace("river", "rivers", 1) for text in TEXTS]
    langs = ["en", None, "und", "dé"]
    numbered = [(i, text, langs[i % 4]) for i, text in enumerate(repeated)]
    documents = spark.createDataFrame(numbered, "doc_id bigint, text string, lang string")
    documents.repartition(3).write.parquet(f"{path}/documents.parquet")
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string")
    pages.write.parquet(f"{path}/pages.parquet")
    rows = [
        (number % 7 or None, turn, role, text)
        for number, (turn, role, text) in enumerate(
            [(i // 3 % 5 or None, ROLES[i % len(ROLES)], TURNS[i % len(TURNS)]) for i in range(200)]
        )
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    turns.repartition(3).write.parquet(f"{path}/conversations.parquet")
    return path


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(name, spark, folder):
    ours = registry.queries()[name](spark, str(folder)).toPandas()
    with duckdb.connect() as duck:
        for table in ("documents", "pages", "conversations"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
        wanted = duck.execute(registry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(wanted.columns)
    key = next(x for x in ("page_id", "doc_id", "conv_id", "phrase") if x in ours)
    key = [key, "lang"] if key == "phrase" else key
    rows = []
    for df in (ours, wanted):
        df = df[sorted(df.columns)].sort_values(key).astype(object)
        rows.append(df.where(df.notna(), None).values.tolist())
    assert rows[0] == rows[1]
    if name == "op5_pii":
        assert ours.n_secret.sum() == 6 and ours.n_iban.sum() and ours.n_national_id.sum() and ours.n_card.sum()
