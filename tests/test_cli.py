import http.server
import json
import stat
import threading

import pytest

from siltstone import cli
from siltstone.plans import execute, work
from siltstone.sources import catalog, files

FEED = '<feed xmlns="http://www.w3.org/2005/Atom"><totalResults>3</totalResults><startIndex>{start}</startIndex>{entries}</feed>'
NAMES = ["math.stackexchange.com_en_all", "physics.stackexchange.com_en_all", "cooking.stackexchange.com_en_all"]


class Handler(http.server.BaseHTTPRequestHandler):
    failures = {"/flaky": 2}
    hits: list[str] = []
    shard = b""

    def do_GET(self):
        self.hits.append(self.path)
        path = self.path.split("?")[0]
        if path in ("/missing", "/hub/none/parquet/default/train") or self.failures.get(path, 0) > 0:
            self.failures[path] = self.failures.get(path, 1) - 1
            self.send_error(503 if path == "/flaky" else 404)
            return
        body = b"data"
        if path == "/categories":
            entries = "".join(f"<entry><title> {t} </title></entry>" for t in ("stack_exchange", "", "broken"))
            body = FEED.format(start=0, entries=entries).encode()
        elif path.startswith("/hub/"):
            body = json.dumps([f"http://{self.headers['Host']}/shards/{k}" for k in range(3)]).encode()
        elif path.startswith("/shards/"):
            body = Handler.shard
        elif path == "/entries" and "category=broken" in self.path:
            body = b"<html>try later</html>"
        elif path == "/entries":
            start = int(self.path.split("start=")[1].split("&")[0])
            entries = "".join(
                f'<entry><id>urn:{n}</id><name>{n}</name><language>eng</language><link rel="x" type="application/x-zim" href="https://h/{n}.zim.meta4" length="7"/></entry>'
                for n in NAMES[start : start + 2]
            )
            body = FEED.format(start=start, entries=entries).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def server():
    web = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=web.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{web.server_port}"
    web.shutdown()


def test_update_then_download(spark, server, tmp_path, caplog):
    """What update writes, download reads; a category that fails is left out with a warning, or is an error."""
    (tmp_path / "history.json").write_text("{}")
    command = ["--datasets", str(tmp_path), "update", "--base-url", server]
    out = cli.main([*command, "--keep-going"], spark)
    assert {tuple(r) for r in out.collect()} == {("math", 1, 7), ("physics", 1, 7)}
    assert "broken is left out" in caplog.text and sorted(p.name for p in tmp_path.glob("*.json")) == ["math.json", "physics.json"]
    plan = cli.main(["--datasets", str(tmp_path), "download", "--dry-run"], spark).collect()
    assert {r["key"]: r["size"] for r in plan} == {f"datasets/{n.split('.')[0]}/{n}.zim": 7 for n in NAMES[:2]}
    with pytest.raises(Exception, match="not a catalog feed"):
        cli.main(command, spark)


def test_fetch_quotes_the_answer(server):
    with pytest.raises(OSError, match="status 404: b'"):
        catalog.fetch(f"{server}/missing", 5)


def test_download(spark, server, tmp_path):
    rows = [("datasets/a/x.zim", f"{server}/x", 4), ("datasets/a/y.zim", f"{server}/flaky", 0), ("datasets/a/z.zim", f"{server}/missing", 0), ("datasets/a/w.zim", f"{server}/w", 5)]
    plan = spark.createDataFrame(rows, "key string, url string, size bigint")
    got = {r["key"][-5]: r["action"] for r in execute.download(plan, str(tmp_path), 2, 2, 0.01).collect()}
    assert got == {"x": "download", "y": "download", "z": "failed", "w": "failed"}
    assert sorted(p.name for p in (tmp_path / "datasets/a").iterdir()) == ["x.zim", "y.zim"]
    again = execute.download(plan.where("key like '%x.zim'"), str(tmp_path), 1)
    assert again.first()["action"] == "skip"
    with pytest.raises(RuntimeError, match="z.zim|w.zim"):
        execute.failures(execute.download(plan, str(tmp_path), 1, 0))
    with pytest.raises(Exception, match="z.zim|w.zim"):
        execute.download(plan, str(tmp_path), 1, 0, stop=True)


def test_commands_on_manifests(spark, tmp_path):
    data = {"datasets/base/a.zim": {"url": "u", "model": "lm-base", "size": 9}, "datasets/math/b.zim": {"url": "u", "model": "lm-math", "size": 5}}
    (tmp_path / "all.json").write_text(json.dumps(data))
    assert cli.main(["--datasets", str(tmp_path), "download", "--dry-run", "--model", "lm-math"], spark).count() == 1
    with pytest.raises(ValueError, match="exceeds"):
        cli.main(["--datasets", str(tmp_path), "download", "--dry-run", "--max-bytes", "10"], spark)
    with pytest.raises(FileNotFoundError, match="not on the path"):
        cli.main(["--datasets", str(tmp_path), "extract", "--dry-run", "--converter", "no-such-tool"], spark)
    with pytest.raises(SystemExit, match="nothing"):
        cli.main(["--datasets", str(tmp_path), "extract", "--dry-run", "--model", "none"], spark)
    assert [r["stage"] for r in cli.main(["--datasets", str(tmp_path), "train", "--dry-run"], spark).collect()] == ["tokenizer", "base", "specialty"]


def test_extract_runs_the_converter(spark, tmp_path):
    tool = tmp_path / "tool.sh"
    tool.write_text('#!/bin/sh\nfor last; do :; done\nmkdir -p "$2/$(basename "$last" .zim)"\necho t > "$2/$(basename "$last" .zim)/p.md"\n')
    tool.chmod(tool.stat().st_mode | stat.S_IEXEC)
    (tmp_path / "datasets/base").mkdir(parents=True)
    (tmp_path / "datasets/base/a.zim").write_text("z")
    rows = spark.createDataFrame([("datasets/base/a.zim",), ("datasets/base/gone.zim",)], "key string")
    plan = work.extract_plan(rows, spark.createDataFrame([], "path string"), str(tool))
    got = {r["key"]: (r["action"], r["error"]) for r in execute.extract(plan, str(tmp_path), 2).collect()}
    assert got == {"datasets/base/a.zim": ("extract", None), "datasets/base/gone.zim": ("failed", "archive not found")}
    assert (tmp_path / "datasets/base/markdown/a/p.md").exists()
    assert {r["action"] for r in execute.extract(plan, str(tmp_path), 2).collect()} == {"skip", "failed"}


def test_extract_tells_what_is_there_and_fails_at_the_end(spark, tmp_path):
    """A dry run knows finished archives; with keep-going the others are still extracted, but the command fails."""
    tool = tmp_path / "tool.sh"
    tool.write_text('#!/bin/sh\nfor last; do :; done\nmkdir -p "$2/$(basename "$last" .zim)"\necho t > "$2/$(basename "$last" .zim)/p.md"\n')
    tool.chmod(tool.stat().st_mode | stat.S_IEXEC)
    (tmp_path / "datasets/base/markdown/done").mkdir(parents=True)
    (tmp_path / "datasets/base/markdown/done/p.md").write_text("x")
    (tmp_path / "datasets/base/markdown/b").mkdir()
    for name in ("a", "b", "done"):
        (tmp_path / f"datasets/base/{name}.zim").write_text("z")
    (tmp_path / "m").mkdir()
    names = ("a", "b", "done", "gone")
    (tmp_path / "m/base.json").write_text(json.dumps({f"datasets/base/{n}.zim": {"url": "u", "model": "lm-base", "size": 1} for n in names}))
    command = ["--datasets", str(tmp_path / "m"), "--root", str(tmp_path), "extract", "--converter", str(tool)]
    plan = {r["key"][14:-4]: r["action"] for r in cli.main([*command, "--dry-run"], spark).collect()}
    assert plan == {"a": "extract", "b": "extract", "done": "skip", "gone": "extract"}
    with pytest.raises(SystemExit, match="1 archives failed"):
        cli.main([*command, "--keep-going"], spark)
    assert (tmp_path / "datasets/base/markdown/a/p.md").exists() and (tmp_path / "datasets/base/markdown/b/p.md").exists()


def test_first_failure_stops_the_others(spark, tmp_path):
    """No item is begun after a failure, and nothing is tried again."""
    begun = tmp_path / "begun"
    begun.mkdir()

    def one(row):
        (begun / row["key"]).touch(exist_ok=False)
        return row["key"], "failed" if row["key"] == "k00" else "done", 0, "broken"

    plan = spark.createDataFrame([(f"k{k:02}", 100 - k) for k in range(20)], "key string, size bigint")
    with pytest.raises(RuntimeError, match="k00: broken"):
        execute._run(plan, str(tmp_path), 1, one, True)
    assert [p.name for p in begun.iterdir()] == ["k00"] and not list(tmp_path.glob(".stopped*"))
    got = execute._run(plan, str(tmp_path / "other"), 4, lambda r: (r["key"], "done", r["size"], None), True)
    assert got.count() == 20 and got.where("action = 'done'").count() == 20


def test_checkpoints_are_gn_files(spark, tmp_path):
    for name in ("model_000007.gn", "model_000300.json", "model_000020.gn", "other_9.gn"):
        (tmp_path / name).write_text("x")
    assert files.require_checkpoint(spark, str(tmp_path)).endswith("model_000020.gn")


def test_train_runs_in_order(spark):
    rows = spark.createDataFrame([("k", "lm-math"), ("k", "lm-art")], "key string, model string")
    calls = []

    class Done:
        def __init__(self, code):
            self.returncode = code

    def run(argv, cwd, env):
        calls.append(argv[2] if "--domain" not in argv else argv[argv.index("--domain") + 1])
        assert env["X"] == "1"
        return Done(int(calls[-1] == "art"))

    assert execute.train(work.train_plan(rows), "go", ".", {"X": "1"}, keep_going=True, run=run) == ["lm-art"]
    assert calls == ["./cmd/tok_train", "base", "art", "math"]
    with pytest.raises(RuntimeError, match="lm-art"):
        execute.train(work.train_plan(rows), "go", ".", {"X": "1"}, run=run)


def test_train_checks_corpora_and_takes_the_latest_checkpoint(spark, tmp_path):
    rows = spark.createDataFrame([("k", "lm-math"), ("k", "lm-art")], "key string, model string")
    settings = work.TrainSettings(datasets=str(tmp_path / "d"), base_dir=str(tmp_path / "c"), reuse_base=True, tokenizer_present=True)
    for path in ("d/math/markdown/x.md", "c/domains/base/base_checkpoints/d20/model_000007.gn"):
        (tmp_path / path).parent.mkdir(parents=True)
        (tmp_path / path).write_text("x")
    calls = []

    def run(argv, cwd, env):
        calls.append(argv[argv.index("--init-model") + 1])
        return type("Done", (), {"returncode": 0})

    checks = {"require_corpus": lambda d: files.require_markdown(spark, d), "checkpoint": lambda: files.require_checkpoint(spark, settings.checkpoint_folder)}
    assert execute.train(work.train_plan(rows, settings), "go", ".", keep_going=True, run=run, **checks) == ["lm-art"]
    assert calls == [str(tmp_path / "c/domains/base/base_checkpoints/d20/model_000007.gn")]
    with pytest.raises(FileNotFoundError, match="no Markdown"):
        execute.train(work.train_plan(rows, settings), "go", ".", run=run, **checks)


def trace_rows(spark, n=7):
    rows = [(f"q{k}", f"<think>t{k}</think>a{k}" if k % 2 else "plain") for k in range(n)]
    return spark.createDataFrame(rows, "instruction string, response string").coalesce(1)


def test_reasoning_command(spark, tmp_path):
    trace_rows(spark).write.parquet(str(tmp_path / "s"))
    out = cli.main(["--root", str(tmp_path), "reasoning", str(tmp_path / "s"), "--slug", "x", "--limit", "5", "--per-file", "2"], spark)
    assert tuple(out.first()) == ("x", 1, 5, 2, 3)
    folder = tmp_path / "datasets/base/markdown/x"
    assert sorted(p.name for p in folder.glob("*.md")) == ["x-00000.md", "x-00001.md", "x-00002.md"]
    assert folder.joinpath("x-00002.md").read_text().count("### Question") == 1
    assert len(spark.read.json(str(tmp_path / "datasets/reasoning/x.jsonl")).collect()) == 2


def test_reasoning_of_the_manifest(spark, server, tmp_path):
    """Shards are listed, fetched only as far as the limit asks, ingested and deleted."""
    trace_rows(spark).write.parquet(str(tmp_path / "s"))
    Handler.shard = next((tmp_path / "s").glob("*.parquet")).read_bytes()
    item = {"url": "", "model": "lm-math", "kind": "reasoning", "repo": "some/traces"}
    (tmp_path / "reasoning.json").write_text(json.dumps({"datasets/reasoning/tr": item}))
    command = ["--root", str(tmp_path), "--datasets", str(tmp_path), "reasoning", "--hub", f"{server}/hub"]
    plan = cli.main([*command, "--dry-run"], spark).collect()
    assert [r["key"] for r in plan] == [f"datasets/reasoning/tr/shard-0000{k}.parquet" for k in range(3)]
    Handler.hits.clear()
    assert tuple(cli.main([*command, "--limit", "9"], spark).first()) == ("tr", 2, 9, 4, 1)
    assert [h for h in Handler.hits if h.startswith("/shards/")] == ["/shards/0", "/shards/1"]
    assert not (tmp_path / "datasets/reasoning/tr").exists() and (tmp_path / "datasets/math/markdown/tr/tr-00000.md").exists()
    out = cli.main([*command, "--repo", "some/traces", "--slug", "one", "--keep-shards"], spark)
    assert tuple(out.first()) == ("one", 3, 21, 9, 1) and len(list((tmp_path / "datasets/reasoning/one").glob("shard*"))) == 3
    with pytest.raises(Exception, match="404"):
        cli.main([*command, "--repo", "none"], spark)
