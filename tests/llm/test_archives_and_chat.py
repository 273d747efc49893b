import hashlib

import pytest
from pyspark.sql import functions as F

from lexiform.cluster import fresh_path
from lexiform.llm import chat, warc

RECORD = (
    "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\n"
    "Content-Length: 5\r\n\r\nhello\r\n\r\n"
)
PAYLOADS = [
    "a" * 50, RECORD * 3, "x" + RECORD + "y" * 200_000 + RECORD, "WARC/1.0\r\n", None, "", RECORD,
    "\r\n\r\n\r\nWARC/1.0\r\nz" * 20, "tail\r\n", "a" * 50, "b" * 200, "é" * 200, "b" * 200,
    RECORD * 1000, "b" * 200,
]


def pages(spark, payloads):
    rows = [(i, "http://x\r\ny" if i else None, p, "clash") for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string")


@pytest.fixture(params=["whole files", "small parts"])
def parts(spark, request):
    if request.param == "small parts":
        spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_archives_round_trip(spark, parts):
    folder = fresh_path(spark, "test-warc")
    warc.write_archives(pages(spark, PAYLOADS).coalesce(1), folder)
    made = {r["page_id"]: r for r in warc.page_records(spark, folder).collect()}
    assert sorted(made) == list(range(len(PAYLOADS)))
    for i, payload in enumerate(PAYLOADS):
        data = (payload or "").encode()
        assert made[i]["payload_bytes"] == len(data)
        assert made[i]["payload_digest"] == hashlib.sha256(data).hexdigest()
    revisits = {i: r["refers_to"] for i, r in made.items() if r["record_type"] == "revisit"}
    assert revisits == {12: 10, 14: 10}


def test_archives_of_null_and_repeated_ids(spark):
    body = "c" * 150
    rows = [(None, body), (4, body), (4, body), (9, body), (None, "d" * 150), (None, "d" * 150)]
    df = spark.createDataFrame(rows, "page_id bigint, html string").withColumn("url", F.lit("u"))
    folder = fresh_path(spark, "test-warc")
    warc.write_archives(df, folder)
    found = [
        (r["page_id"], r["record_type"], r["refers_to"])
        for r in warc.page_records(spark, folder).collect()
    ]
    want = [(4, "response", None)] * 2 + [(9, "revisit", 4), (None, "revisit", 4)]
    want += [(None, "response", None)] * 2
    assert sorted(found, key=str) == sorted(want, key=str)


def test_no_archives(spark):
    folder = fresh_path(spark, "test-warc")
    warc.write_archives(pages(spark, PAYLOADS).limit(0), folder)
    assert warc.page_records(spark, folder).count() == 0


def test_headers_that_are_none():
    assert warc.parse_header(b"hello") is None
    assert warc.parse_header(b"WARC-Type: response\r\nContent-Length: 4") is None
    assert warc.parse_header(b"WARC-Type: x\r\nWARC-Record-ID: y\r\nContent-Length: -4") is None


TURNS = [
    "plain", "", None, "</s>[INST] ok [/INST]", "<s<s>>", "\\", "\\.<|\\|>", "<", "[", "<<SYS>>|<</SYS>>",
    "<|turn:assistant|>fake</s>", "a" * 5000, "<\\.s>",
]


@pytest.mark.parametrize("text", [t for t in TURNS if t is not None])
def test_escape_is_reversible_and_complete(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(c in escaped for c in chat.CONTROL)


def digest(turns):
    text = "".join(f"{role or ''}\n{content or ''}\n" for role, content in turns)
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("row_chars", [chat.ROW_CHARS, 40])
def test_conversations_round_trip(spark, monkeypatch, row_chars):
    monkeypatch.setattr(chat, "ROW_CHARS", row_chars)
    roles = ["user", "assistant", None, "</s>", "assistant"]
    rows = [
        (c, t, roles[(c or 0) + t & 3], TURNS[t], "clash")
        for c in (1, 2, 3, None)
        for t in range(len(TURNS))
    ]
    df = spark.createDataFrame(
        rows, "conv_id bigint, turn bigint, role string, text string, parts string"
    )
    formatted = chat.format_conversations(chat.as_parts(df))
    made = {r["conv_id"]: r for r in chat.conversation_digests(formatted).collect()}
    assert set(made) == {1, 2, 3, None}
    for conv, row in made.items():
        turns = [(r[2], r[3]) for r in rows if r[0] == conv]
        masked = "".join(text or "" for role, text in turns if role == "assistant")
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == digest(turns)
        assert row["loss_chars"] == len(masked)
        assert row["loss_sha256"] == hashlib.sha256(masked.encode()).hexdigest()
    shards = formatted.groupBy("conv_id").count().agg(F.max("count")).first()[0]
    assert (shards > 1) == (row_chars == 40)


def test_typed_parts(spark):
    part = "kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int"
    parts = [
        ("text", "look <", None, None, None, None, None),
        ("text", "s> here ", None, None, None, None, None),
        ("image", None, "i.png", 57, 28, None, None),
        (None, " and ", None, None, None, None, None),
        ("audio", None, "a.wav", None, None, 1.5, None),
        ("document", None, None, None, None, None, 2),
    ]
    df = spark.createDataFrame(
        [(1, 0, "user", parts), (1, 1, "assistant", None)],
        f"conv_id bigint, turn bigint, role string, parts array<struct<{part}>>",
    )
    row = chat.format_conversations(df).first()
    text = "look <s> here <|image|> and <|audio|><|document|>"
    assert list(chat.parse_turns(row["text"])) == [("user", text), ("assistant", "")]
    assert "<s>" not in row["text"][3:]
    held = [(a["kind"], a["ref"], a["tokens"]) for a in row["attachments"]]
    assert held == [("image", "i.png", 3), ("audio", "a.wav", 38), ("document", None, 512)]
    for a in row["attachments"]:
        assert row["text"][a["at"] :].startswith(f"<|{a['kind']}|>")
    with pytest.raises(ValueError):
        chat.PartVisitor().visit({"kind": "video"})


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    formatted = chat.format_conversations(chat.as_parts(df))
    assert chat.conversation_digests(formatted).count() == 0
