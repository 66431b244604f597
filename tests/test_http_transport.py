"""The HTTP transport of the paged source, with ``urlopen`` replaced in-process
(no network, no server): request URLs, retries, page and cursor parsing."""

import io
import json
import urllib.parse

import pytest

from wareloom.sources import paged as P


class FakeResponse(io.BytesIO):
    def __enter__(self):
        return self

    def __exit__(self, *a):
        return False


@pytest.fixture
def calls(monkeypatch):
    seen = []
    failures = {"left": 1}

    def fake_urlopen(req, timeout=None):
        url = req.full_url
        seen.append(url)
        q = dict(urllib.parse.parse_qsl(urllib.parse.urlsplit(url).query))
        if "flaky" in url and failures["left"]:
            failures["left"] -= 1
            raise OSError("connection reset")
        if q.get("$select", "").startswith("count"):
            body = [{"n": "2500"}]
        elif "cursor" in url:
            body = {"value": [{"id": 1}], "next": None if "page2" in url else "https://h/cursor/page2"}
        else:
            off, lim = int(q["$offset"]), int(q["$limit"])
            body = [{"id": i} for i in range(off, min(off + lim, 2500))]
        return FakeResponse(json.dumps(body).encode())

    monkeypatch.setattr(P.urllib.request, "urlopen", fake_urlopen)
    monkeypatch.setattr(P.time, "sleep", lambda s: None)
    return seen


def test_offset_paging_requests(calls):
    t = P.HttpTransport({"url": "https://h/resource.json", "order": ":id", "where": "id > 5"})
    assert t.count() == 2500
    recs = t.fetch(1000, 1000)
    assert recs[0] == {"id": 1000} and len(recs) == 1000
    q = dict(urllib.parse.parse_qsl(urllib.parse.urlsplit(calls[-1]).query))
    assert q == {"$limit": "1000", "$offset": "1000", "$order": ":id", "$where": "id > 5"}


def test_partition_plan_from_count(calls):
    r = P.PagedRecordsReader({"transport": "http", "url": "https://h/r.json", "page_size": "1000",
                              "pages_per_partition": "2"})
    parts = r.partitions()
    assert [(p.first_page, p.pages) for p in parts] == [(0, 2), (2, 1)]
    rows = [row for p in parts for row in r.read(p)]
    assert len(rows) == 2500 and rows[-1][0] == 2


def test_retry_and_cursor(calls):
    t = P.HttpTransport({"url": "https://h/flaky.json", "retries": "2"})
    assert len(t.fetch(0, 10)) == 10  # first attempt failed, second succeeded
    c = P.HttpTransport({"url": "https://h/cursor/page1"})
    recs, nxt = c.follow("https://h/cursor/page1")
    assert recs == [{"id": 1}] and nxt == "https://h/cursor/page2"
    assert c.follow(nxt)[1] is None


def test_pushed_filters_become_where(calls):
    from pyspark.sql import datasource as ds
    from pyspark.sql.types import StructType, StructField, LongType

    r = P.TypedPagedReader({"transport": "http", "url": "https://h/r.json", "where": "kind = 'a'"},
                           StructType([StructField("id", LongType())]))
    left = list(r.pushFilters([ds.GreaterThan(("id",), 10), ds.EqualTo(("other",), 1)]))
    assert left == [ds.EqualTo(("other",), 1)]  # unknown column: Spark keeps it
    r._transport().fetch(0, 5)
    q = dict(urllib.parse.parse_qsl(urllib.parse.urlsplit(calls[-1]).query))
    assert q["$where"] == "(kind = 'a') AND (id > 10)"


@pytest.fixture
def layers(monkeypatch):
    """A map service: counts on request, records two levels deep, no more than 400 to a page, a token."""
    seen = []

    def fake_urlopen(req, timeout=None):
        url, form = req.full_url, req.data
        q = dict(urllib.parse.parse_qsl(urllib.parse.urlsplit(url).query))
        seen.append((url, form))
        if "token" in url and form:
            assert form == b"user=u"
            body = {"access": {"token": "t1"}}
        elif q.get("returnCountOnly"):
            body = {"result": {"count": 900}}
        else:
            assert q["token"] == "t1"
            total = 900 if q.get("year", "2020") == "2020" else 30
            off, lim = int(q["resultOffset"]), min(int(q["resultRecordCount"]), 400)
            body = {"result": {"records": [{"id": i} for i in range(off, min(off + lim, total))]}}
        return FakeResponse(json.dumps(body).encode())

    monkeypatch.setattr(P.urllib.request, "urlopen", fake_urlopen)
    return seen


LAYER = {"transport": "http", "url": "https://h/layer/query", "page_size": "500", "records_key": "result.records", "limit_param": "resultRecordCount",
         "offset_param": "resultOffset", "count_params": '{"returnCountOnly": "true"}', "count_key": "result.count", "token_url": "https://h/token",
         "token_form": '{"user": "u"}', "token_key": "access.token", "pages_per_partition": "1"}


def rows(options):
    reader = P.PagedRecordsReader(options)
    return [json.loads(r) for p in reader.partitions() for _, r in reader.read(p)]


def test_counted_layer_with_nested_records_and_a_token(layers):
    assert [r["id"] for r in rows(LAYER)] == list(range(900))
    assert sum(form is not None for _, form in layers) == 3  # one token for the plan and one per task


def test_count_free_paging_and_loop_values(layers):
    looped = LAYER | {"paging": "open", "loop_values": "[2020, 2021]", "loop_param": "year", "loop_column": "yr"}
    got = rows(looped)
    assert [(r["yr"], r["id"]) for r in got] == [(2020, i) for i in range(900)] + [(2021, i) for i in range(30)]
    assert not any("returnCountOnly" in url for url, _ in layers)
