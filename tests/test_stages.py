"""From image files to Markdown and a report; failures, stops, repeats."""

from __future__ import annotations

import json

import numpy as np
import pytest

from leafmill import __main__ as cli
from leafmill import stages
from leafmill.operators import prompts
from leafmill.sources import images
from leafmill.sources import models as M


def reply(*elements):
    return json.dumps([{"bbox": [0, 10 * i, 40, 10 * i + 9], "category": c, "text": t} for i, (c, t) in enumerate(elements)])


def read(request: str) -> str:
    """Reads a page by its shade of gray."""
    width = _shade(request)
    if width == 43:
        raise M.Rejected("HTTP 400: no")
    if width == 42:
        return reply(("Text", "it goes on in lower case"), ("Formula", "x_{1"))
    return reply(("Title", "# A page"), ("Text", f"wide {width} and"), ("Picture", None), ("Caption", "Fig. 1")) if width == 41 else reply(("Text", "alone"))


def _page(request: str):
    import base64

    url = json.loads(request)["content"][0]["image_url"]["url"]
    return images.read_png(base64.b64decode(url.partition(",")[2]))


def _shade(request: str) -> int:
    return int(_page(request)[5, 5, 0])


def proofread(request: str) -> str:
    text = json.loads(request)["content"][1]["text"]
    if "KIND:" in text:
        assert text.endswith("Its caption: Fig. 1") and _page(request).ndim == 3
        again = len(json.loads(request)["content"]) > 2
        return f"KIND: graph\n<description>two dots</description>\n<structure>\\node (a) {{}}; \\node (b) {{}}; \\draw (a) -- ({'b' if again else 'c'});</structure>"
    assert "latex_braces" in text and "<draft>\nx_{1\n</draft>" in text
    return "VERDICT: fixed\n<latex>\nx_{1}\n</latex>"


@pytest.fixture
def inputs(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, width in (("a", 41), ("b", 42), ("c", 43)):
        (folder / f"{name}.png").write_bytes(images.png(np.full((56, 56, 3), width, np.uint8)))
    (folder / "d.jpg").write_bytes(b"\xff\xd8 broken")
    return str(folder)


def test_all_stages(spark, tmp_path, inputs, capsys):
    work, out = str(tmp_path / "work"), str(tmp_path / "out")
    say = lambda *argv: cli.main([*argv, "--work", work], spark, read, proofread)
    assert say("all", "--inputs", inputs, "--out", out, "--workers", "2", "--retries", "1") == stages.DONE
    docs = {p.name.partition("-")[0]: p for p in (tmp_path / "out").iterdir()}
    assert sorted(docs) == ["a", "b", "c"]
    md = {k: (p / f"{p.name}.md").read_text() for k, p in docs.items()}
    assert md["a"].startswith("<!-- page 1 -->\n\n# A page\n\nwide 41 and\n\n![Figure (page 1)](figures/p0001_b02.png)\n\n<details><summary>Figure description (generated) — graph as Markdown and as TikZ</summary>\n\n**Kind:** graph. two dots")
    assert md["a"].endswith("</details>\n\n*Fig. 1*\n") and "2 vertices, 1 edges" in md["a"]
    assert images.read_png((docs["a"] / "figures" / "p0001_b02.png").read_bytes()).shape[2] == 3
    assert md["b"] == "<!-- page 1 -->\n\nit goes on in lower case\n\n$$\nx_{1}\n$$\n"
    assert md["c"] == "<!-- page 1: OCR failed, see report.json -->\n"
    report = json.loads((docs["b"] / "report.json").read_text())
    assert report["review_errors"] == 0 and report["truncated_pages"] == [] and report["review"] == {"edited": 1} and report["n_pages"] == 1 and report["reviewed_pages"] == 1 and report["block_types"] == {"formula": 1, "text": 1}
    assert json.loads((docs["c"] / "report.json").read_text())["failed_pages"] == [1]
    w = stages.Work(spark, work)
    assert [r["error"][:9] for r in w.table("failures").collect()] == ["NoDecoder"]
    capsys.readouterr()
    assert say("status") == say("todo", "--of", "read") == say("todo", "--of", "read", "--retry-failed") == say("todo", "--of", "review", "--force") == 0
    told = capsys.readouterr().out.splitlines()
    assert told[-4:] == ["3/3 documents assembled", "0", "1", "3"]

    def never(request):
        raise AssertionError(f"nothing is left to do: {request[-80:]}")

    assert cli.main(["all", "--inputs", inputs, "--out", out, "--work", work], spark, never, never) == stages.DONE
    assert say("read", "--force") == stages.DONE and w.to_review().count() == 3  # a new reading takes its review back


def test_a_server_that_is_down_and_a_stop(spark, tmp_path, inputs):
    w = stages.Work(spark, str(tmp_path / "work"))
    w.ingest([inputs])

    def down(request):
        raise M.Unavailable("503")

    assert stages.run(w, [(lambda: w.read(down, "layout-json", retries=0, pause=0.0), {})]) == stages.FAILED
    assert w.to_read().count() == 3 and w.done("read").count() == 0
    flag = M.StopFlag(str(tmp_path / "stop"))
    w.stop = flag
    flag.set()
    assert stages.run(w, [(lambda: w.read(read, "layout-json"), {})]) == stages.STOPPED and w.to_read().count() == 3
    flag.clear()
    assert stages.run(w, [(lambda: w.read(read, "layout-json", pause=0.0), {})]) == stages.DONE
    assert stages.run(w, [(lambda: w.review(down, pause=0.0, limit=1), {})]) == stages.FAILED
    left = {r["doc_id"][0] for r in w.to_review().collect()}
    assert left == {"a", "b"}  # a figure and a formula wait; the page without either is reviewed


def test_turned_pages_are_read_again(spark, tmp_path):
    """A reader that says a page is turned sees it turned, and so does the reviewer."""
    page = np.full((40, 80, 3), 255, np.uint8)
    page[:, :20] = 10
    (tmp_path / "p.png").write_bytes(images.png(page))
    seen = str(tmp_path / "seen")

    def model(request):
        shown, asked = _page(request), json.loads(request)
        with open(seen, "a") as f:
            f.write(f"{shown.shape[:2]} {asked['temperature']}\n")
        ok = shown.shape[0] > shown.shape[1]
        return f"---\nis_rotation_valid: {ok}\nrotation_correction: {0 if ok else 90}\n---\n# upright\n\n\\[a_{{\\]"

    def proof(request):
        shown = _page(request)
        with open(seen, "a") as f:
            f.write(f"review {shown.shape[0] > shown.shape[1]}\n")
        return "VERDICT: correct"

    w = stages.Work(spark, str(tmp_path / "work"))
    w.ingest([str(tmp_path / "p.png")])
    w.read(model, "dollar-markdown", retries=0, workers=1)
    w.review(proof, workers=1)
    got = w.done("review").first()["blocks"]
    assert [(b["type"], b["content"], b["rotation"], b["reviewed"]) for b in got] == [("title", "upright", 90, None), ("formula", "a_{", 90, "agreed")]
    assert [h["decision"] for h in got[1]["history"]] == ["kept (reviewer agreed)"]
    lines = open(seen).read().splitlines()
    assert lines == ["(644, 1288) 0.1", "(1288, 644) 0.1", "review True"]


def test_formulas_in_katex(spark, tmp_path):
    """A stand-in worker: it refuses what holds `bad` and dies of `die`."""
    import sys

    from leafmill.sources import katex

    worker = tmp_path / "worker.py"
    worker.write_text("import sys, json\nfor line in sys.stdin:\n    t = json.loads(line)['tex']\n    if 'die' in t:\n        sys.exit(3)\n    print(json.dumps('no' if 'bad' in t else None), flush=True)\n")
    start = [sys.executable, str(worker)]
    assert katex.errors([("x", True), ("bad", True)], start) == [None, "no"] and katex.errors([("x", True)], None) == [None]
    assert katex.errors([("x", True), ("die", True), ("x", True)], start) == [None, katex.UNCHECKED, katex.UNCHECKED]
    assert katex.errors([("x", True)], ["/no/such/program"]) == [katex.UNCHECKED]
    rows = spark.createDataFrame([(1, "$$x$$"), (2, "bad"), (3, "bad {"), (4, None)], "i int, content string")
    assert {r["i"]: r["katex"] for r in katex.katex_flags(rows, start=start).collect()} == {1: None, 2: "latex_katex", 3: None, 4: None}
    assert {r["katex"] for r in katex.katex_flags(rows).collect()} == {None}


def test_id_collisions_are_refused(spark, tmp_path, inputs):
    w = stages.Work(spark, str(tmp_path / "work"))
    w.ingest([inputs])
    w.append("manifest", w.latest("manifest", ["doc_id"]).selectExpr("doc_id", "source", "'other' AS sha256", "n_pages"))
    with pytest.raises(ValueError, match="stands for another file"):
        w.ingest([inputs])


def test_prompts(spark):
    rows = spark.createDataFrame([("formula", "x", ["empty", "repeated"]), ("text", "", []), ("table", "| a |", [])], "type string, content string, flags array<string>")
    said = [r[0] for r in rows.select(prompts.review_prompt(rows["type"], rows["content"], rows["flags"])).collect()]
    assert "<draft>\nx\n</draft>" in said[0] and "flagged: empty, repeated (written more than once" in said[0] and "<latex>" in said[0]
    assert "<draft>" not in said[1] and "<text>" in said[1] and "<table_out>" in said[2] and "flagged" not in said[2]
