"""What a catalog's server is asked for: filters in the request, and streams that read only what is new."""

import http.server
import threading
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from siltstone.sources import catalog


class Handler(http.server.BaseHTTPRequestHandler):
    entries: dict[tuple[str, str], list[str]] = {}
    asked: list[tuple[str, ...]] = []
    most = 3  # of a page, whatever is asked for
    totals = True

    def do_GET(self):
        url = urlparse(self.path)
        if url.path == "/categories":
            self.asked.append(("categories",))
            body = "".join(f"<entry><title> {s} </title></entry>" for s in dict.fromkeys(s for s, _ in self.entries))
        else:
            q = {k: v[0] for k, v in parse_qs(url.query).items()}
            start, count = int(q["start"]), int(q["count"])
            self.asked.append((q["category"], q["lang"], start, count))
            found = self.entries.get((q["category"], q["lang"]), [])
            told = f"<totalResults>{len(found)}</totalResults>" if self.totals else ""
            body = f"{told}<startIndex>{start}</startIndex>" + "".join(f"<entry><id>{e}</id></entry>" for e in found[start : start + min(count, self.most)])
        self.send_response(200)
        self.end_headers()
        self.wfile.write(f'<feed xmlns="http://www.w3.org/2005/Atom">{body}</feed>'.encode())

    def log_message(self, *args):
        pass


@pytest.fixture
def server():
    Handler.entries = {("a", "eng"): [f"a{k}" for k in range(7)], ("b", "eng"): [f"b{k}" for k in range(2)], ("b", "deu"): ["bd0"], ("c d", "eng"): []}
    Handler.asked, Handler.totals = [], True
    web = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=web.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{web.server_port}"
    web.shutdown()


def ids(pages):
    return sorted(r["id"] for r in catalog.feed_entries(pages.select("value")).select("id").collect())


def test_only_what_is_named_is_asked_for(spark, server):
    pages = catalog.read_catalog(spark, server, categories="a", lang="eng")
    assert ids(pages) == [f"a{k}" for k in range(7)]
    assert Handler.asked == [("a", "eng", k, 100) for k in (0, 3, 6)]  # neither other categories nor their list
    Handler.asked.clear()
    some = catalog.read_catalog(spark, server, categories="b,none", lang="eng,deu")
    assert ids(some) == ["b0", "b1", "bd0"]
    assert {a[:2] for a in Handler.asked} == {(s, lang) for s in ("b", "none") for lang in ("eng", "deu")}
    Handler.asked.clear()
    every = catalog.read_catalog(spark, server)
    assert ids(every) == sorted([*(f"a{k}" for k in range(7)), "b0", "b1"]) and Handler.asked[0] == ("categories",)
    Handler.entries = {}
    assert catalog.read_catalog(spark, server).count() == 0


def test_filters_leave_other_queries_alone(spark, server):
    """Also with filter pushdown on, queries on one DataFrame see their own rows."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        pages = catalog.read_catalog(spark, server, lang="eng,deu")
        one, two = pages.where("site = 'a'"), pages.where("site = 'b' AND lang = 'deu'")
        assert ids(one.union(two)) == [*(f"a{k}" for k in range(7)), "bd0"]
        assert pages.where("site = 'none'").count() == 0 and pages.where("error IS NULL").count() == 5 and pages.count() == 5
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def stream(spark, server, folder, **options):
    pages = catalog.read_catalog(spark, server, stream=True, **options)
    writer = pages.writeStream.format("parquet").option("path", str(folder / "out")).option("checkpointLocation", str(folder / "state"))
    writer.trigger(availableNow=True).start().awaitTermination(120)
    return spark.read.schema(pages.schema).parquet(str(folder / "out"))


def test_a_second_read_asks_only_for_new_entries(spark, server, tmp_path):
    first = stream(spark, server, tmp_path, count="5")
    assert ids(first) == [*(f"a{k}" for k in range(7)), "b0", "b1"]
    Handler.asked.clear()
    Handler.entries[("a", "eng")] += ["a7", "a8"]
    Handler.entries[("e", "eng")] = ["e0"]
    again = stream(spark, server, tmp_path, count="5")
    assert ids(again) == [*(f"a{k}" for k in range(9)), "b0", "b1", "e0"]
    assert {a for a in Handler.asked if a != ("categories",) and a[2:] != (0, 1)} == {("a", "eng", 7, 2)}
    assert ("e", "eng", 0, 1) in Handler.asked
    Handler.asked.clear()
    assert stream(spark, server, tmp_path, count="5").count() == again.count()
    assert all(a == ("categories",) or a[2:] == (0, 1) for a in Handler.asked)


def test_a_stream_needs_totals(spark, server, tmp_path):
    Handler.totals = False
    with pytest.raises(Exception, match="tells no total"):
        stream(spark, server, tmp_path)
