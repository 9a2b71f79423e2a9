"""WARC derivatives and the choice of lexicon entries, held against versions that are built another way."""

import base64
import gzip
import hashlib
import io
import json
import math
import random
import zlib

import pytest

from quarrystone.llm import toxicity, warc

WORDS = ["stone", "Brücke", "vale", "ключ", "tally", "fern", "日本", "oak"]
ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&eacute;", "é"), ("&#8211;", "–")]


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def random_page(rng):
    """A page with what must come of it: (html, title, links, lines of text)."""
    out, lines, links, title = ["<!DOCTYPE html><html><head>"], [], [], None
    if rng.random() < 0.7:
        title = " ".join(rng.sample(WORDS, 2)) + " & more"
        out.append(f"<TITLE lang='x'>{title.replace('&', '&amp;')}</TITLE>")
    out.append(rng.choice(["", "<style>p { color: red }</style>", "<script type='a'>if (a < b) { '<p>no</p>' }</script>"]) + "</head><body>")
    for _ in range(rng.randrange(6)):
        parts, said = [], []
        for _ in range(rng.randrange(1, 6)):
            kind = rng.randrange(5)
            word = rng.choice(WORDS)
            if kind == 0:
                code, sign = rng.choice(ENTITIES)
                parts.append(f"{word}{code}{word}")
                said.append(f"{word}{sign}{word}")
            elif kind == 1:
                link, quote = f"/{rng.randrange(99)}?a=1&b={word}", rng.choice("\"'")
                parts.append(f"<a class=z href={quote}{link.replace('&', '&amp;')}{quote}>{word}</a>")
                said.append(word)
                links.append(link)
            elif kind == 2:
                parts.append(f"<b>{word}</b>")
                said.append(word)
            elif kind == 3:
                parts.append(rng.choice(["<!-- <p>hidden</p> -->", "<noscript>none</noscript>"]))
            else:
                parts.append(word)
                said.append(word)
        tag = rng.choice(["p", "div", "li", "H2", "td><tr"])
        out.append(f"<{tag}>" + rng.choice([" ", "\n ", "&nbsp; "]).join(parts) + f"</{tag.split('>')[0]}>")
        lines.append(" ".join(said))
    out.append(rng.choice(["</body></html>", "", "<script>never closed"]))
    return "".join(out), title, links, [x for x in lines if x]


def record(headers, block):
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in headers) + b"Content-Length: %d\r\n\r\n" % len(block) + block


def test_derivatives_are_those_that_the_pages_were_made_for(spark):
    rng, sources = random.Random(61), []
    for i in range(120):
        page, title, links, lines = random_page(rng)
        charset = rng.choice(["utf-8", "utf-16", None])
        payload = page.encode(charset or "utf-8")
        coding, sent = rng.choice(["plain", "gzip", "deflate", "chunked"]), payload
        http = [("Content-Type", "text/html" + (f"; charset={charset}" if charset else ""))]
        if coding in ("gzip", "deflate"):
            sent = gzip.compress(payload, mtime=0) if coding == "gzip" else zlib.compress(payload)
            http.append(("Content-Encoding", coding))
        elif coding == "chunked":
            cuts = sorted({0, len(payload), *(rng.randrange(len(payload)) for _ in range(3))})
            sent = b"".join(b"%x\r\n%s\r\n" % (b - a, payload[a:b]) for a, b in zip(cuts, cuts[1:])) + b"0\r\n\r\n"
            http.append(("Transfer-Encoding", "chunked"))
        block = ("HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {v}\r\n" for k, v in http) + "\r\n").encode() + sent
        head = [("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:test:{i}>"), ("WARC-Date", "2020-02-02T02:02:02Z"), ("WARC-Target-URI", f"http://h/{i}"), ("WARC-Payload-Digest", sha1(sent))]
        sources.append((i, record(head, block), head, http, sent, block, title, links, "\n".join(lines)))
    df = spark.createDataFrame([(s[0], bytearray(s[1])) for s in sources], "page_id bigint, response binary").repartition(4)
    found = {}
    for r in warc.derivatives(df).collect():
        found[r.page_id, r.warc_type] = r
    assert len(found) == 2 * len(sources)
    for i, whole, head, http, sent, block, title, links, text in sources:
        meta, conv = found[i, "metadata"], found[i, "conversion"]
        body = {
            "Source": {"WARC-Headers": [list(h) for h in [*head, ("Content-Length", str(len(block)))]], "Block-Digest": sha1(block), "Block-Length": len(block)},
            "HTTP": {"Status": "HTTP/1.1 200 OK", "Headers": [list(h) for h in http]},
            "Payload": {"Digest": sha1(sent), "Declared-Digest": sha1(sent), "Length": len(sent)},
            "HTML": {"Title": title, "Links": links},
        }
        blocks = {"metadata": bytes(meta.record).split(b"\r\n\r\n", 1)[1], "conversion": text.encode()}
        assert json.loads(blocks["metadata"]) == body
        for r, other, kind in ((meta, conv, "application/json"), (conv, meta, "text/plain")):
            data = blocks[r.warc_type]
            want = [("WARC-Type", r.warc_type), ("WARC-Record-ID", r.record_id), ("WARC-Date", "2020-02-02T02:02:02Z"), ("WARC-Target-URI", f"http://h/{i}"), ("WARC-Refers-To", f"<urn:test:{i}>"), ("WARC-Concurrent-To", other.record_id), ("WARC-Block-Digest", sha1(data)), ("Content-Type", kind)]
            assert bytes(r.record) == record(want, data)
            assert (r.refers_to, r.concurrent_to, r.target_uri, r.block_digest, r.content_length, r.source_payload_digest) == (f"<urn:test:{i}>", other.record_id, f"http://h/{i}", sha1(data), len(data), sha1(sent))
    assert len({r.record_id for r in found.values()}) == len(found)


class Counted(io.BytesIO):
    def read(self, n=-1):
        assert n <= 1 << 20
        return super().read(n)


def test_records_are_read_in_pieces_and_damage_is_an_error():
    some = [record([("WARC-Type", "x"), ("N", i)], b"\r\n\r\n" * i + b"a" * (i * 300_000)) for i in range(12)]
    whole = b"".join(r + b"\r\n\r\n" for r in some)
    members = b"".join(gzip.compress(r + b"\r\n\r\n") for r in some)
    for data in (whole, members, gzip.compress(whole)):
        assert [bytes(r) for r in warc.read_records(Counted(data))] == some
    assert list(warc.read_records(io.BytesIO(b""))) == [] and list(warc.read_records(io.BytesIO(gzip.compress(b"")))) == []
    assert [bytes(r) for r in warc.read_records(io.BytesIO(whole[:-4]))] == some
    bomb = gzip.compress(b"WARC/1.1\r\nX: " + b"y" * (200 << 20), 1)  # a head without an end: told before it's unpacked
    for bad, said in ((bomb, "no end of a head"), (whole[:-9], "cut short"), (whole + b"WARC/1.1\r\nA: b", "without an end"), (members[:-40], "ends early"), (members[:60] + b"\0" * 40 + members[100:], "damaged|early|cut|head")):
        with pytest.raises(ValueError, match=said):
            list(warc.read_records(io.BytesIO(bad)))


def by_hand(rows, max_entries, min_docs):
    """Lexicon and exceptions by looking for each candidate in each text."""
    texts = [(toxicity.folded_words(t), y) for t, y in rows]
    low, high = toxicity.MIN_LETTERS, toxicity.MAX_LETTERS
    candidates = {e for ws, _ in texts for w in ws if len(w) >= low for e in [f" {w} ", *(f" {w[:k]}" for k in range(low + 1, high + 1) if k <= len(w))]}
    matches = lambda e, w: e.strip() == w if e.endswith(" ") else w.startswith(e[1:])
    total = [sum(y == k for _, y in texts) for k in (0, 1)]
    p = total[1] / sum(total)
    counted = {e: [sum(y == k and any(matches(e, w) for w in ws) for ws, y in texts) for k in (0, 1)] for e in candidates}
    counted = {e: n for e, n in counted.items() if sum(n) >= min_docs}
    scored = []
    for e, (good, bad) in counted.items():
        weight = math.log((bad + 0.5) / (total[1] + 1)) - math.log((good + 0.5) / (total[0] + 1))
        rate = bad / (good + bad)
        ratio = bad * math.log(rate / p) + (good * math.log((1 - rate) / (1 - p)) if good else 0.0) if bad else -1.0
        if bad >= min_docs and weight > 1 and ratio > math.log(len(counted)):
            scored.append((-round(ratio, 9), e, weight))
    weights = {e: w for _, e, w in sorted(scored)[:max_entries]}
    seen = {}
    for ws, y in texts:
        here = {" ".join(ws[k : k + 2]) for i, w in enumerate(ws) if any(matches(e, w) for e in weights) for k in (i - 1, i) if 0 <= k < len(ws) - 1}
        for phrase in here:
            n = seen.setdefault(phrase, [0, 0])
            n[0], n[1] = n[0] + 1, n[1] + y
    fit = sorted((-n, ph) for ph, (n, bad) in seen.items() if n >= 5 and bad <= 0.1 * n)
    return weights, {ph for _, ph in fit[:max_entries]}


@pytest.mark.parametrize("max_entries", [5000, 7])
def test_entries_and_exceptions_are_those_of_a_search_by_hand(spark, max_entries):
    rng, rows = random.Random(62), []
    plain = [f"{a}{b}" for a in ("ra", "mo", "ki", "lu") for b in ("ven", "sto", "lir", "nd")]
    for i in range(220):
        bad = i % 4 == 0
        words = [rng.choice(plain) for _ in range(12)]
        if bad:
            words[3:3] = rng.sample(["wretch", "wretched", "v1leness", "scum", "SCUMMY"], 2)
        elif i % 20 == 3:
            words[5:5] = ["pond", "scum"]
        rows.append((" ".join(words), int(bad)))
    rows += [(None, 0), ("", 1), ("scum " * 50, 1)]
    lexicon = toxicity.learn(spark.createDataFrame(rows, "text string, y int").repartition(3), max_entries)
    weights, exceptions = by_hand(rows, max_entries, 4)
    assert set(lexicon.weights) == set(weights) and all(abs(lexicon.weights[e] - w) < 1e-9 for e, w in weights.items())
    assert lexicon.exceptions == exceptions
    assert len(weights) == 7 or max_entries > 7 and len(weights) > 7
    assert "pond scum" in exceptions or max_entries == 7
