"""Graph drawings and model calls."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from leafmill.operators import graphs as G
from leafmill.operators import tikz as Z
from leafmill.sources import models as M


def edge(path, options="", nodes="ab"):
    code = f"\\begin{{tikzpicture}}[{options}]" + "".join(f"\\node ({n}) at (0,1) {{}};" for n in nodes) + path + "\\end{tikzpicture}"
    g = Z.parse_graph(code)
    assert g["flags"] == [], g["problems"]
    return [(e["u"] + ("<>" if e["both"] else ">" if e["directed"] else "-") + e["v"]) for e in g["edges"]]


@pytest.mark.parametrize(
    ("path", "options", "want"),
    [
        (r"\draw (a) -- (b);", "", ["a-b"]), (r"\draw[->] (a) -- (b);", "", ["a>b"]), (r"\draw[<-] (a) -- (b);", "", ["b>a"]), (r"\draw[<->] (a) -- (b);", "", ["a<>b"]),
        (r"\draw[-{Stealth[length=2mm]}] (a) to[out=-30] (b);", "", ["a>b"]), (r"\draw (a) -- (b);", "->", ["a>b"]), (r"\draw[-] (a) -- (b);", "->", ["a-b"]),
        (r"\draw[arc] (a) -- (b);", "arc/.style={->, thick}", ["a>b"]), (r"\path (a) edge[loop above] () edge (b);", "", ["a-a", "a-b"]), (r"\draw (a) -- (b) -- (a);", "", ["a-b", "b-a"]),
        (r"\path (a) -- (b);", "", []), (r"\tikzset{every edge/.style={->}} \path (a) edge (b);", "", ["a>b"]), (r"\begin{scope}[->] \draw (a)--(b); \end{scope} \draw (b)--(a);", "", ["a>b", "b-a"]),
        (r"\draw[postaction={decorate}, decoration={markings, mark=at position .5 with {\arrow{>}}}] (a) -- (b);", "", ["a>b"]), (r"\draw[arrows={latex-latex}] (a) -- (b);", "", ["a<>b"]),
    ],
)
def test_edges(path, options, want):
    assert edge(path, options) == want


def test_nodes_and_labels():
    g = Z.parse_graph("```latex\n\\node[label=above:$v_1$] (v1) at (0,0) {}; % note\n\\node (b) [right=of v1] {$[0,1)$};\n\\draw (v1) -- node[above] {3} (b);\n```")
    assert [(n["id"], n["label"], n["x"]) for n in g["nodes"]] == [("v1", "$v_1$", 0.0), ("b", "$[0,1)$", None)] and g["edges"][0]["label"] == "3" and g["flags"] == []


@pytest.mark.parametrize(
    ("code", "flags"),
    [("{", ["tikz_parse"]), ("", ["tikz_parse"]), (r"\node (a) {}; \draw (a) -- (c);", ["tikz_undeclared"]), (r"\draw (a) -- (b);", ["tikz_empty", "tikz_undeclared"]), (r"\node (a) {}; \node (a) {};", ["tikz_parse"]), (r"\node (a) {}; \foreach \x in {1} {\node (b) {};}", ["tikz_unsupported"]), (r"\node (a) {}; \fill (0,0);", ["tikz_parse"])],
)
def test_flags(code, flags):
    assert Z.parse_graph(code)["flags"] == flags


def test_graph_columns(spark):
    df = spark.createDataFrame([(1, r"\node (a) {A}; \node (b) {}; \draw[->] (a) -- (b);"), (2, None)], "k int, code string")
    r = df.select("k", Z.graph("code").alias("g")).orderBy("k").collect()
    assert r[1]["g"]["flags"] == ["tikz_parse"]
    assert [tuple(x) for x in Z.edges(df, "k", "code").select("k", "u", "v", "directed").collect()] == [(1, "a", "b", True)]
    assert df.where("k = 1").select(Z.graph("code").alias("g")).select(G.edge_set(F.col("g.nodes"), F.col("g.edges"))).first()[0] == ["A>b"]


def test_model_calls(spark):
    def model(request):
        if request == "no":
            raise M.Rejected("4xx")
        if request == "down":
            raise M.Unavailable("503")
        if request == "bug":
            raise KeyError(request)
        return M.CutOff("part") if request == "long" else request.upper()

    df = spark.createDataFrame([(i, r) for i, r in enumerate(["a", "no", "bug", "long", "down", "b"])], "i int, request string").coalesce(1)
    got = {r["i"]: (r["reply"], r["error_kind"]) for r in M.answered(df, model, workers=1, retries=1, pause=0.0).collect()}
    assert got == {0: ("A", None), 1: (None, "rejected"), 2: (None, "error"), 3: ("part\n<<TRUNCATED>>", None), 4: (None, "unavailable"), 5: ("B", None)}


def test_breaker():
    asked = []

    def down(request):
        asked.append(request)
        raise M.Unavailable

    call = M.Caller(down, retries=0, pause=0.0, limit=2)
    assert [call(str(i))[1] for i in range(5)] == ["unavailable"] * 5 and asked == ["0", "1"]


def test_breaker_under_threads_and_stops(tmp_path):
    import threading
    from concurrent.futures import ThreadPoolExecutor

    gate = threading.Barrier(8)

    def down(request):
        gate.wait(10)
        raise M.Unavailable

    call = M.Caller(down, retries=0, pause=0.0, limit=8)
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(call, map(str, range(8))))
    assert call.misses == 8 and call("x")[2] == "too many failures in a row"
    moods = iter([M.Unavailable("a"), M.Rejected("b"), M.Unavailable("c")])

    def moody(request):
        raise next(moods)

    call = M.Caller(moody, retries=0, pause=0.0, limit=2)
    assert [call("x")[1] for _ in range(4)] == ["unavailable", "rejected", "unavailable", "unavailable"] and call.misses == 2
    flag = M.StopFlag(str(tmp_path / "stop"))
    call = M.Caller(str, stop=flag)
    assert call("x")[0] == "x"
    flag.set()
    assert call("x")[1] == "stopped"
    assert M.system_error(OSError(28, "full")) and not M.system_error(OSError("odd")) and not M.system_error(ValueError())


def test_endpoint():
    import json
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Server(BaseHTTPRequestHandler):
        def say(self, code, body):
            self.send_response(code)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def do_GET(self):
            self.say(200, {"data": [{"id": "the-model"}]})

        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            said = asked["messages"][-1]["content"]
            code = {"no": 400, "down": 503}.get(said, 200)
            self.say(code, {"choices": [{"message": {"content": f"{asked['model']}: {said}"}, "finish_reason": "length" if said == "long" else "stop"}]})

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        ask = M.ChatEndpoint(f"http://127.0.0.1:{server.server_port}")
        assert ask("hello") == "the-model: hello" and isinstance(ask("long"), M.CutOff)
        with pytest.raises(M.Rejected, match="HTTP 400"):
            ask("no")
        with pytest.raises(M.Unavailable, match="HTTP 503"):
            ask("down")
    finally:
        server.shutdown()
    with pytest.raises(M.Unavailable):
        M.ChatEndpoint("http://127.0.0.1:1", timeout=2).first_model()
