"""VAL-17: whether formulas parse in KaTeX, where node and the package are installed.

A batch of formulas goes to a process of its own, one JSON line each way a formula, so nothing is
shared between tasks and a process that dies costs its batch a second start. Off by default."""

from __future__ import annotations

import json
import shutil
import subprocess
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.flags import latex_flags
from leafmill.functions.text import strip_math_delims
from leafmill.session import ship

UNCHECKED = "KaTeX worker unavailable"
STARTS = 4
WORKER = """
const katex = require(process.argv[1]), fs = require('fs');
for (const line of fs.readFileSync(0, 'utf8').split('\\n').filter(x => x)) {
  const {tex, display} = JSON.parse(line);
  let said = null;
  try { katex.renderToString(tex, {displayMode: display, throwOnError: true, strict: 'ignore', trust: false}); }
  catch (e) { said = String(e.message || e).slice(0, 300); }
  fs.writeSync(1, JSON.stringify(said) + '\\n');
}
"""


def command(module: str | None) -> list[str] | None:
    """How to start a worker, or None where node or the package (a folder) is missing."""
    node = shutil.which("node")
    return [node, "-e", WORKER, module] if node and module else None


def errors(formulas: Sequence[tuple[str, bool]], start: list[str] | None) -> list[str | None]:
    """For each (tex, display) the parser's error, None if it parses or the check is off, or
    UNCHECKED where no worker answers. A worker that stops half-way is replaced, a few times."""
    if start is None:
        return [None] * len(formulas)
    out: list[str | None] = []
    for _ in range(STARTS):
        left = formulas[len(out) :]
        if not left:
            break
        asked = "".join(json.dumps({"tex": t, "display": d}) + "\n" for t, d in left)
        try:
            done = subprocess.run(start, input=asked, capture_output=True, text=True, encoding="utf-8", errors="replace", timeout=60 + len(left))
            said = done.stdout
        except (OSError, subprocess.SubprocessError) as e:
            said = getattr(e, "stdout", None) or ""
            said = said.decode(errors="replace") if isinstance(said, bytes) else said
        for line in said.splitlines()[: len(left)]:
            try:
                out.append(json.loads(line))
            except ValueError:
                break
    return out + [UNCHECKED] * (len(formulas) - len(out))


def katex_flags(formulas: DataFrame, of: str = "content", module: str | None = None, start: list[str] | None = None) -> DataFrame:
    """Adds katex: latex_katex, latex_unchecked or null, for displayed formulas whose structure is
    sound; others are not asked about."""
    ship(formulas.sparkSession)
    begin = start or command(module)

    @F.pandas_udf("string")
    def asked(tex: pd.Series) -> pd.Series:
        some = [t for t in tex if t is not None and t.strip()]
        said = iter(errors([(t, True) for t in some], begin))
        found = [next(said) if t is not None and t.strip() else None for t in tex]
        return pd.Series([None if e is None else "latex_unchecked" if e == UNCHECKED else "latex_katex" for e in found], dtype=object)

    body: Column = strip_math_delims(F.col(of))
    return formulas.withColumn("katex", asked(F.when(F.size(latex_flags(body)) == 0, body)))
