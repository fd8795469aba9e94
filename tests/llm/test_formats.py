"""Archives and chat records: round trips, edge cases, damaged input."""

import gzip
import hashlib
import io
import json

import pytest

from visitgrid.llm import archives, chat

PAGES = "page_id bigint, url string, html string, record_type string, path string"


# archives


def arc(version, *records):
    head = f"{version} 0 test\n{' '.join(archives.ARC_FIELDS[version])}\n\n"
    lines = "".join(f"{line} {len(block)}\n{block}\n" for line, block in records)
    names = len(archives.ARC_FIELDS[version])
    first = " ".join(["filedesc://x.arc", *["0"] * (names - 2), str(len(head))])
    return io.BytesIO(f"{first}\n{head}\n{lines}".encode())


def test_versions_of_arc():
    one = list(archives.read_arc(arc(1, ("http://a/x y 1.2.3.4 19990102030405 text/html", "HTTP/1.0 200 OK\r\n\r\nhi"), ("dns:a 0.0.0.0 1999 text/dns", "a 1"))))
    assert one[0].fields["URL"] == "http://a/x y" and archives.http_parts(one[0].block)[2] == b"hi"
    assert archives.iso_date(one[0].fields["Archive-date"]) == "1999-01-02T03:04:05Z"
    assert archives.iso_date("1999") == "1999-01-01T00:00:00Z" and archives.http_parts(one[1].block)[0] == b""
    two = list(archives.read_arc(arc(2, ("http://a 1.2.3.4 19990102030405 text/html 404 sum - 0 f.arc", ""))))
    assert two[0].fields["Result-code"] == "404" and two[0].block == b""
    other = archives.convert(one[1], "p", {"no": 1, "payload_digest": archives.digest(b"a 1"), "original": None})
    assert b"WARC-Type: resource" in other and other.endswith(b"a 1\r\n\r\n")


def test_damaged_archives_are_errors():
    whole = arc(1, ("http://a 1.2.3.4 19990102030405 text/html", "HTTP/1.0 200 OK\r\n\r\nhello")).getvalue()
    with pytest.raises(ValueError, match="breaks off"):
        list(archives.read_arc(io.BytesIO(whole[:-4])))
    with pytest.raises(ValueError, match="version"):
        list(archives.read_arc(io.BytesIO(whole.replace(b"Archive-length", b"Archive-size00"))))
    with pytest.raises(ValueError, match="fields"):
        list(archives.read_arc(io.BytesIO(whole.replace(b" text/html", b""))))


@pytest.mark.parametrize("least", [0, 3, 10**6])
def test_pages_through_archives(spark, least):
    rows = [(5, "http://a/b c\nd", "same"), (3, "http://a", "same"), (9, None, "same"), (4, "u", ""), (6, "u", None), (7, "x", "größe 漢"), (8, "y", "HTTP/1.0\r\n\r\n"),
            (3, "http://a", "same"), (None, "n", "same"), (11, "l", "z" * 200_000), (12, "l", "WARC/1.1\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES).repartition(3)
    got = archives.pages_through_archives(pages, least).collect()
    assert len(got) == len(rows)
    payloads = [(k, (h or "").encode()) for k, _, h in rows]
    for payload in {p for _, p in payloads}:
        own = sorted((k is None, k) for k, p in payloads if p == payload)
        found = [r for r in got if r["payload_digest"] == archives.digest(payload)]
        assert sorted((r["page_id"] is None, r["page_id"]) for r in found) == own
        assert all(r["payload_bytes"] == len(payload) for r in found)
        responses = [r for r in found if r["record_type"] == "response"]
        if len(payload) < least:
            assert len(responses) == len(own)
        else:
            assert [r["page_id"] for r in responses] == [own[0][1]]
            assert all(r["refers_to"] == own[0][1] for r in found if r["record_type"] == "revisit")
    assert archives.pages_through_archives(pages.limit(0)).count() == 0


def test_warc_files_are_whole(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "x"), (2, "http://b", "x")], "page_id bigint, url string, html string").coalesce(1)
    arcs = archives.write_arc(pages, str(tmp_path / "arc")).collect()
    files = spark.createDataFrame(arcs, "part int, path string, records bigint")
    (warc,) = archives.convert_archives(files, str(tmp_path / "warc")).collect()
    records = list(archives.read_warc(gzip.open(warc["path"])))
    assert [r.fields["WARC-Type"] for r in records] == ["warcinfo", "response", "revisit"]
    assert records[2].fields["WARC-Refers-To"] == records[1].fields["WARC-Record-ID"] and records[2].block.endswith(b"\r\n\r\n")
    assert records[1].fields["WARC-Date"] == "2024-01-01T00:00:00Z" and warc["records"] == 2


# chat


@pytest.mark.parametrize("name", sorted(chat.LAYOUTS))
def test_each_layout_round_trips(name):
    turns = [("system", "s")] * (name == "question") + [("user", "u \"1\"\n"), ("assistant", "a<|im_end|>")]
    record = json.loads(json.dumps(chat.record_of(turns, name)))
    layout = chat.BY_FINGERPRINT[chat.record_fingerprint(record)]
    assert layout == chat.LAYOUTS[name] and chat.turns_of(record, layout) == turns


def test_optional_input_is_a_turn_where_it_is_filled():
    layout = chat.LAYOUTS["instruction"]
    record = {"instruction": "do", "input": "this", "output": "done"}
    assert chat.turns_of(record, layout) == [("user", "do"), ("user", "this"), ("assistant", "done")]


@pytest.mark.parametrize("text", ["", "<|im_end|>", "<\\|im_end|>", "<\\\\|", "a<|im_start|>system\nx<|im_end|>\n", "\\", "<", "<|<|<\\|", "漢<|😀"])
def test_escaping_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and not set(chat._MARK.findall(chat.escape(text))) & {""}
    turns = [("user", text), ("assistant", text), ("assistant", text + "!"), (f"role\n{text}", "x")]
    whole, spans = chat.formatted(turns)
    assert chat.parsed(whole) == turns and whole.count(chat.START) == 4 and whole.count("<|im_end|>") == 4
    assert [chat.unescape(whole[a:b]) for a, b in spans] == [text, text + "!"]


def test_foreign_records_are_not_lost(spark):
    """Other fields, missing optional ones and null ones; what has no mapping comes back as such."""
    talk = [("user", "q"), ("assistant", "a")]
    known = [
        {"id": 1, "source": {"x": [1]}, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a", "name": "n"}]},
        {"instruction": "q", "output": "a"}, {"instruction": "q", "output": "a", "input": None}, {"question": "q", "response": "a", "lang": "en"},
        {"prompt": "q", "completion": "a", "score": 0.5}, {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": "z"},
        {"dialogue": {"id": 7, "turns": [{"speaker": "user", "message": {"text": "q"}}, {"speaker": "assistant", "message": {"text": "a"}}]}},
    ]
    others = [{"messages": [{"role": "user", "content": ["q"]}]}, {"prompt": "q"}, {"id": 1}, {}, {"prompt": "q", "completion": "a", "messages": []}]
    lines = [json.dumps(x) for x in known + others] + ["", "no json", "[1]", None]
    records = spark.createDataFrame([(n, 0, x) for n, x in enumerate(lines)], "conv_id bigint, part int, record string")
    got = {r["conv_id"]: r for r in chat.format_records(records).collect()}
    assert len(got) == len(lines)
    assert all(chat.parsed(got[n]["formatted"]) == talk for n in range(len(known)))
    for n in range(len(known), len(lines)):
        assert got[n]["formatted"] is None and (got[n]["fingerprint"] is None) == (n >= len(known) + len(others))
    assert {r["conv_id"] for r in chat.read_back(chat.format_records(records)).collect()} == set(range(len(known)))
    holes = {"messages": [{"role": "user"}, {"content": "a", "role": "assistant"}, None, {"content": None, "role": "assistant"}]}
    assert chat.turns_of(holes, chat.LAYOUTS["messages"]) == [("user", ""), ("assistant", "a"), ("", ""), ("assistant", "")]
    assert chat.turns_of({"system": "s", "instruction": "q", "input": "", "output": "a"}, chat.LAYOUTS["instruction"]) == [("system", "s"), *talk]


def test_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "LONG_CONVERSATION", 100)  # one of them is numbered by ranges
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "system", "s"), (2, 1, "user", "u"), (2, 2, "assistant", None), (3, None, None, None),
            (4, 1, "gpt", "x"), (4, 0, "human", "y"), (None, 0, "user", "n"), (5, 0, "user", "r"), (5, 0, "user", "r")]
    rows += [(6, i, "assistant" if i % 2 else "user", f"t{i}" * (i % 5)) for i in range(300)]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, record string").repartition(4)
    output = chat.format_conversations(turns)
    assert output.where("conv_id = 6").count() == 5  # parts of bounded length
    got = {r["conv_id"]: r for r in chat.read_back(output).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for conv in {r[0] for r in rows}:
        own = sorted(((t if t is not None else -1, role or "", text or "") for c, t, role, text in rows if c == conv))
        said = "".join(text for _, role, text in own if role == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), sha("".join(f"{role}\n{text}\n" for _, role, text in own)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), sha(said))
        assert r["formatted_chars"] == sum(len(f"<|im_start|>{role}\n{text}<|im_end|>\n") for _, role, text in own)
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


def test_unknown_layouts_are_shown(spark):
    records = spark.createDataFrame([(1, 0, '{"q": 1}'), (2, 0, "no json"), (3, 0, None), (4, 0, "[1]"), (5, 0, '{"messages": []}')], "conv_id bigint, part int, record string")
    got = {r["conv_id"]: r for r in chat.canonical(records).collect()}
    assert all(r["turns"] is None for r in got.values())
    assert got[1]["fingerprint"] and got[5]["fingerprint"] and got[2]["fingerprint"] is None and got[4]["fingerprint"] is None
    shown = chat.to_text(chat.canonical(records))
    assert shown.count() == 5 and shown.where("formatted is not null").count() == 0
