"""From files to Markdown in stages that can be stopped, repeated and resumed.

Each stage reads tables of a work folder that driver and executors share, does what is left, and
appends rows; the last row of a key counts. A stage works in rounds of bounded size: what a round
has finished is kept, whatever happens to the next. Where a model server fails, its pages stay to
be done; where a request can never succeed, a placeholder stands for the page.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from leafmill.functions.flags import block_flags
from leafmill.functions.text import reader_tag
from leafmill.operators import reports as R
from leafmill.operators.assembly import assemble
from leafmill.operators.blocks import best_attempt, reading_loss
from leafmill.operators.figures import crop_name, describe, needs_description
from leafmill.operators.prompts import figure_prompt, review_prompt, with_image, with_problems
from leafmill.operators.readers import TURNS, asks_turn, decoding, page_size, reader
from leafmill.operators.review import Policy, recheck, reviewed, wanted
from leafmill.schema import HISTORY
from leafmill.session import settled, ship
from leafmill.sources import files, images, models

#: Exit codes: done, wrong use, a server or the system failed, stopped and to be run again.
DONE, USAGE, FAILED, STOPPED = 0, 2, 3, 85

BLOCKS = "array<struct<block_no:int,type:string,content:string,bbox:array<double>,source:string,flags:array<string>,level:int,json_repaired:boolean,repeated:int,truncated_tail:boolean,tail_recovered:boolean,rotation:int,image:string,alt:string,kind:string,description:string,description_error:string,reviewed:string,decision:string,previous:string,history:array<struct<source:string,verdict:string,decision:string,proposal:string,previous:string,previous_source:string>>>>"
SCHEMAS = {
    "manifest": "doc_id string, source string, sha256 string, n_pages long, run long",
    "pages": images.PAGES + ", run long",
    "failures": "doc_id string, error string, run long",
    "read": f"doc_id string, page int, reader string, failed boolean, error string, blocks {BLOCKS}, run long",
    "review": f"doc_id string, page int, reader string, failed boolean, error string, blocks {BLOCKS}, run long",
    "documents": "doc_id string, failed_pages long, run long",
}
_FIELDS = [x.split(":")[0] for x in "block_no:int type:string content:string bbox:x source:x flags:x level:x json_repaired:x repeated:x truncated_tail:x tail_recovered:x rotation:x image:x alt:x kind:x description:x description_error:x reviewed:x decision:x previous:x history:x".split()]


class Stopped(Exception):
    """A stop was asked for; what was under way is saved."""


class ServerDown(Exception):
    """Some work is left because a model did not answer."""


@dataclass
class Work:
    """The tables of one work folder, and how its stages run."""

    spark: SparkSession
    root: str
    round: int = 2000  # pages of a round
    stop: Callable[[], bool] = field(default=lambda: False)

    def table(self, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.root}/{name}")
        except AnalysisException:
            return self.spark.createDataFrame([], SCHEMAS[name])

    def latest(self, name: str, keys: list[str]) -> DataFrame:
        """The last row of each key."""
        rows = self.table(name)
        rest = [c for c in rows.columns if c not in (*keys, "run")]
        return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "run").alias("x"), F.max("run").alias("run")).select(*keys, "x.*", "run")

    def append(self, name: str, rows: DataFrame) -> None:
        columns = [c.split()[0] for c in SCHEMAS[name].split(", ")]
        run = int(self.table(name).agg(F.coalesce(F.max("run"), F.lit(0))).first()[0]) + 1
        rows.withColumn("run", F.lit(run).cast("long")).select(*columns).write.mode("append").parquet(f"{self.root}/{name}")

    def check(self) -> None:
        if self.stop():
            raise Stopped

    # -------------------------------------------------------------- stages

    def ingest(self, inputs: list[str], dpi: int = images.DPI, force: bool = False) -> None:
        """SRC-12: files whose pages are not all there are rendered; a new file under an id that
        stands for other bytes is refused; forced pages take what was made of them along."""
        paths = [p for _, p in files.listed(inputs)]
        if not paths:
            return
        found = images.load_files(self.spark, paths).drop("content")
        found = R.drop_copies(found)
        known = self.latest("manifest", ["doc_id"])
        clash = files.collisions(known, found).select("doc_id").limit(1).collect()
        if clash:
            raise ValueError(f"{clash[0]['doc_id']} stands for another file already")
        lost = R.missing_pages(known.select("doc_id", "n_pages"), self.latest("pages", ["doc_id", "page"]).where("png IS NOT NULL").select("doc_id", F.col("page").cast("long").alias("page"))).select("doc_id").distinct()
        todo = found if force else found.join(known.join(lost, "doc_id", "left_anti"), "doc_id", "left_anti")
        names = [r["path"] for r in todo.select("path").sort("path").collect()]  # the driver listed these files itself
        for at in range(0, len(names), self.round):
            self.check()
            pages = images.render(images.load_files(self.spark, names[at : at + self.round]), dpi)
            self.append("pages", pages)
            last = self.table("pages").agg(F.max("run")).first()[0]
            made = self.table("pages").where(F.col("run") == last)
            self.append("failures", made.where("error IS NOT NULL").select("doc_id", "error"))
            fresh = made.where("error IS NULL").groupBy("doc_id").agg(F.max("source").alias("source"), F.max("sha256").alias("sha256"), F.count("*").alias("n_pages"))
            if force:
                gone = fresh.select("doc_id", F.explode(F.sequence(F.lit(0), F.col("n_pages").cast("int") - 1)).alias("page"))
                for stage in ("read", "review"):
                    self.append(stage, _blank(gone))
            self.append("manifest", fresh)  # last: it says that a document is there

    def every_page(self) -> DataFrame:
        manifest = self.latest("manifest", ["doc_id"]).where("n_pages > 0")
        return manifest.select("doc_id", F.explode(F.sequence(F.lit(0), F.col("n_pages").cast("int") - 1)).alias("page"))

    def done(self, stage: str) -> DataFrame:
        return self.latest(stage, ["doc_id", "page"]).where("blocks IS NOT NULL")

    def to_read(self, force: bool = False, retry_failed: bool = False) -> DataFrame:
        return R.to_read(self.every_page(), self.done("read"), force, retry_failed)

    def to_review(self, force: bool = False) -> DataFrame:
        return R.to_review(self.done("read"), self.done("review"), force).select("doc_id", "page")

    def rounds(self, todo: DataFrame):
        """Work lists of about `round` pages each, by a hash of the page, taken down first."""
        count = max(1, -(-todo.count() // self.round))
        listed = todo.select("doc_id", "page").withColumn("_round", F.pmod(F.xxhash64("doc_id", "page"), F.lit(count)))
        listed = settled(listed)
        for k in range(count):
            self.check()
            yield listed.where(F.col("_round") == k).drop("_round")

    def read(self, model: Callable[[str], str], name: str, model_name: str = "model", prompt: str = "", retries: int = 1, force: bool = False, retry_failed: bool = False, **how) -> None:
        """RDB-06: each page is read until a reading is whole, `retries` times more at most; the
        best counts. A page whose requests can never succeed gets a placeholder."""
        down, tag = 0, reader_tag(F.lit(name), F.lit(model_name))
        for todo in self.rounds(self.to_read(force, retry_failed)):
            pages = self.latest("pages", ["doc_id", "page"]).join(todo, ["doc_id", "page"]).select("doc_id", "page", "width", "height", "png")
            size = page_size(name, F.col("width"), F.col("height"))
            pages = pages.withColumn("_s", size).select("doc_id", "page", "png", F.col("_s.w").alias("width"), F.col("_s.h").alias("height"))
            left, every, told = pages, None, None
            for attempt in range(retries + 1):
                got = self.asked(left, model, name, prompt, attempt, **how)
                blocks = _blocks(reader(name), got.where("reply IS NOT NULL"), tag)
                loss = reading_loss(blocks, ["doc_id", "page", "attempt"])
                empty = got.where("reply IS NOT NULL").select("doc_id", "page", "attempt").join(loss, ["doc_id", "page", "attempt"], "left_anti")
                loss = loss.unionByName(empty.select("*", F.lit(0.0).alias("lost"), F.lit(0).cast("long").alias("repeated"), F.lit(0).cast("long").alias("kept_chars")))
                every = (blocks, loss) if every is None else (every[0].unionByName(blocks), every[1].unionByName(loss))
                told = got if told is None else told.unionByName(got)
                fine = loss.where("lost = 0 AND repeated = 0").select("doc_id", "page")
                later = got.where("error_kind IN ('unavailable', 'stopped')").select("doc_id", "page")
                left = left.join(fine, ["doc_id", "page"], "left_anti").join(later, ["doc_id", "page"], "left_anti")
                if left.isEmpty():
                    break
            best = best_attempt(every[1], ["doc_id", "page"]).select("doc_id", "page", "attempt")
            whole = best.join(every[0], ["doc_id", "page", "attempt"], "left").groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.when(F.col("block_no").isNotNull(), F.struct(*_FIELDS)))).alias("blocks"))
            saved = whole.select("doc_id", "page", tag.alias("reader"), F.lit(False).alias("failed"), F.lit(None).cast("string").alias("error"), F.col("blocks").cast(BLOCKS).alias("blocks"))
            errors = told.groupBy("doc_id", "page").agg(F.max_by("error", "attempt").alias("error"), F.bool_or(F.col("error_kind").isin("unavailable", "stopped")).alias("later"))
            dead = R.placeholder_pages(errors.where("NOT later").join(saved, ["doc_id", "page"], "left_anti").select("doc_id", "page", "error"))
            marks = F.array(F.struct(*[F.col(c) if c in ("block_no", "type", "content", "flags") else tag.alias(c) if c == "source" else F.lit(None).alias(c) for c in _FIELDS])).cast(BLOCKS)
            self.append("read", saved.unionByName(dead.select("doc_id", "page", tag.alias("reader"), "failed", "error", marks.alias("blocks"))))
            self.append("review", _blank(todo.join(self.table("review").select("doc_id", "page"), ["doc_id", "page"], "left_semi")))
            down += told.where("error_kind = 'unavailable'").select("doc_id", "page").join(saved, ["doc_id", "page"], "left_anti").count()
        self.check()
        if down:
            raise ServerDown(f"{down} page(s) not read")

    def asked(self, pages: DataFrame, model: Callable[[str], str], name: str, prompt: str, attempt: int, **how) -> DataFrame:
        """One reading of pages (doc_id, page, png, width, height): with reply, error_kind, error,
        attempt, text and rotation. A page that a reader says is turned is shown as it asks, a few
        times; each is a further attempt to the sampler."""
        todo, out = pages.withColumn("rotation", F.lit(0)), None
        for k in range(TURNS + 1):
            how_ = decoding(name, F.lit(attempt + k))
            shown = images.sized("png", "width", "height", F.when(F.col("rotation") > 0, F.col("rotation")))
            request = with_image(F.lit(prompt), shown, how_["temperature"].alias("temperature"), how_["top_p"].alias("top_p"))
            ready = todo.select("doc_id", "page", "width", "height", "rotation", request.alias("request"))
            got = settled(models.answered(ready, model, stop=self.stop, **how).drop("request").withColumn("_turn", asks_turn(name, F.col("reply"))))
            again = (F.col("_turn") > 0) & F.lit(k < TURNS)
            done = got.where(~again)
            out = done if out is None else out.unionByName(done)
            turns = got.where(again).select("doc_id", "page", F.pmod(F.col("rotation") + F.col("_turn"), F.lit(360)).alias("rotation"))
            if turns.isEmpty():
                break
            todo = pages.join(turns, ["doc_id", "page"])
        return out.drop("_turn").withColumns({"attempt": F.lit(attempt), "text": F.col("reply")})

    def review(self, model: Callable[[str], str], model_name: str = "model", policy: Policy = Policy(), force: bool = False, figures: bool = True, **how) -> None:
        """REV-12, REV-14, FIG-06: the blocks that policy wants go to the reviewer, and figures to be
        described; a page is saved once none of its blocks waits for a server."""
        down, source = 0, f"reviewer:{model_name}"
        for todo in self.rounds(self.to_review(force)):
            read = self.done("read").join(todo, ["doc_id", "page"])
            blocks = read.select("doc_id", "page", F.inline("blocks"))
            blocks = blocks.withColumn("flags", recheck(F.col("flags"), F.col("type"), F.col("content")))
            ask = wanted(blocks, policy)
            page = self.latest("pages", ["doc_id", "page"]).select("doc_id", "page", "png", "width", "height")
            asked = images.cuttings(ask.join(page, ["doc_id", "page"], "left"), turn="rotation").drop("png", "width", "height")
            asked = asked.withColumn("request", with_image(review_prompt(F.col("type"), F.col("content"), F.col("flags")), F.col("cut"))).drop("cut")
            got = settled(models.answered(asked, model, stop=self.stop, **how).drop("request"))
            late = got.select("doc_id", "page", "error_kind")
            if figures:
                blocks, described_ = self.described(blocks, page, model, **how)
                late = late.unionByName(described_.select("doc_id", "page", "error_kind"))
            waits = late.where("error_kind IN ('unavailable', 'stopped')").select("doc_id", "page").distinct()
            out = reviewed(got.where("error_kind IS NULL OR error_kind IN ('rejected', 'error')").drop("reviewed", "decision", "previous", "tail_recovered"), source, policy)
            rest = blocks.join(got.select("doc_id", "page", "block_no"), ["doc_id", "page", "block_no"], "left_anti")
            every = rest.select("doc_id", "page", *_FIELDS).unionByName(out.select("doc_id", "page", *_FIELDS)).join(waits, ["doc_id", "page"], "left_anti")
            pages = every.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct(*_FIELDS))).cast(BLOCKS).alias("blocks"))
            whole = read.drop("blocks", "run").join(waits, ["doc_id", "page"], "left_anti").join(pages, ["doc_id", "page"], "left")
            self.append("review", whole.withColumn("blocks", F.coalesce("blocks", F.array().cast(BLOCKS))))
            down += late.where("error_kind = 'unavailable'").count()
        self.check()
        if down:
            raise ServerDown(f"{down} request(s) failed")

    def described(self, blocks: DataFrame, pages: DataFrame, model: Callable[[str], str], **how) -> tuple[DataFrame, DataFrame]:
        """FIG-05: blocks with what a model says of the figures that lack a description, and what
        became of each request."""
        place = ["doc_id", "page", "block_no"]
        captions = R.captions(blocks.select(*place, "type", "content"))
        wanted_ = needs_description(blocks).select(*place, "bbox", "rotation").join(captions, place, "left").join(pages, ["doc_id", "page"], "left")
        cut = images.cuttings(wanted_, 0.005, turn="rotation")
        told = describe(cut.select(*place, with_image(figure_prompt(F.col("caption")), F.col("cut")).alias("request")), model, with_problems, stop=self.stop, **how)
        told = settled(told.select(*place, "error_kind", "error", F.col("flags").alias("_flags"), F.col("kind").alias("_kind"), F.col("description").alias("_description")))
        out = blocks.join(told.drop("error_kind"), place, "left")
        none = F.array().cast("array<string>")
        fresh = {
            "kind": F.coalesce("kind", "_kind"),
            "description": F.coalesce("description", F.when(F.col("error").isNull(), F.col("_description"))),
            "description_error": F.coalesce("error", "description_error"),
            "flags": F.array_sort(F.array_union(F.coalesce("flags", none), F.coalesce(F.when(F.col("error").isNull(), F.col("_flags")), none))),
        }
        return out.withColumns(fresh).select(blocks.columns), told

    def pages_now(self) -> DataFrame:
        """SRC-15: each page as reviewed, or else as read."""
        return R.latest_pages(self.done("read"), self.done("review"), ["doc_id", "page"], ["reader", "failed", "error", "blocks"])

    def assemble(self, out: str, marks: bool = True) -> None:
        """SNK-03: documents all of whose pages are read become Markdown and a report each."""
        now = self.pages_now()
        have = now.groupBy("doc_id").agg(F.count("*").alias("have"))
        full = self.latest("manifest", ["doc_id"]).join(have, "doc_id").where("have = n_pages")
        pages = now.join(full.select("doc_id"), "doc_id", "left_semi")
        blocks = pages.select("doc_id", "page", "failed", F.inline_outer("blocks")).withColumn("tail", F.coalesce("truncated_tail", F.lit(False)))
        blocks = blocks.withColumn("block_no", F.coalesce("block_no", F.lit(0)))
        text = assemble(blocks, marks)
        shown = R.report(blocks.where("type IS NOT NULL").select("doc_id", "page", "block_no", "type", "flags"))
        seen = pages.groupBy("doc_id").agg(F.array_sort(F.collect_set("reader")).alias("readers"), F.count_if(F.col("stage") == "review").alias("reviewed_pages"), F.array_sort(F.collect_list(F.when(F.col("failed"), F.col("page") + 1))).alias("failed_pages"))
        lost = blocks.groupBy("doc_id").agg(
            F.array_sort(F.collect_set(F.when(F.col("tail") & (F.trim(F.coalesce("content", F.lit(""))) == ""), F.col("page") + 1))).alias("truncated_pages"),
            F.array_sort(F.collect_set(F.when(F.col("tail_recovered"), F.col("page") + 1))).alias("truncated_recovered"),
            F.count_if((F.col("reviewed") == "error") | F.col("description_error").isNotNull()).alias("review_errors"),
        )
        decided = blocks.where("reviewed IS NOT NULL").groupBy("doc_id").agg(F.collect_list("reviewed").alias("r")).select("doc_id", R.tally(F.col("r")).alias("review"))
        fields = ["doc_id", "source", "n_pages", "readers", "work", "reviewed_pages", "failed_pages", "truncated_pages", "truncated_recovered", "review_errors", "block_types", "review", "open_flags", "flagged_blocks"]
        told = full.join(seen, "doc_id").join(shown.drop("n_pages"), "doc_id", "left").join(decided, "doc_id", "left").join(lost, "doc_id", "left").withColumn("work", F.lit(self.root))
        drawn = blocks.where("image IS NOT NULL AND bbox IS NOT NULL").select("doc_id", "page", "block_no", "type", "bbox")
        cut = images.figure_cuttings(drawn, self.latest("pages", ["doc_id", "page"]))
        images.save_images(cut.select("doc_id", F.col("image").alias("name"), F.col("cut").alias("png")), out)
        rows = text.join(told, "doc_id").select("doc_id", "markdown", F.to_json(F.struct(*fields)).alias("report"))
        files.save_files(rows, out)
        self.append("documents", told.select("doc_id", F.size("failed_pages").cast("long").alias("failed_pages")))

    def status(self) -> DataFrame:
        """AGG-05, SNK-11: pages, read and reviewed, of each document, and whether it is assembled."""
        key = ["doc_id", "page"]
        flags = self.every_page().join(self.done("read").select(*key, F.lit(True).alias("is_read")), key, "left").join(self.done("review").select(*key, F.lit(True).alias("is_reviewed")), key, "left")
        spans = R.spans(flags.select("doc_id", F.coalesce("is_read", F.lit(False)).alias("is_read"), F.coalesce("is_reviewed", F.lit(False)).alias("is_reviewed")), ["doc_id"])
        made = self.table("documents").select("doc_id", F.lit(True).alias("assembled")).distinct()
        return spans.join(made, "doc_id", "left").withColumn("assembled", F.coalesce("assembled", F.lit(False)))

    def status_text(self) -> str:
        """The status as a table of fixed width, and a line of sums."""
        shown = self.status().orderBy("doc_id").collect()
        table = [("doc_id", "pages", "read", "review", "md"), *((r["doc_id"][:50], r["pages"], r["read"], r["review"], "yes" if r["assembled"] else "-") for r in shown)]
        lines = [" ".join([name.ljust(50), *(str(n).rjust(w) for n, w in zip(numbers, (5, 5, 6), strict=True)), md]) for name, *numbers, md in table]
        return "\n".join([*lines, f"{sum(r['assembled'] for r in shown)}/{len(shown)} documents assembled"])


def _blank(pages: DataFrame) -> DataFrame:
    """Rows that take back what was done for pages (STR-03)."""
    none = lambda kind: F.lit(None).cast(kind)
    return pages.select("doc_id", "page", none("string").alias("reader"), F.lit(False).alias("failed"), none("string").alias("error"), none(BLOCKS).alias("blocks"))


def _blocks(read: Callable[[DataFrame], DataFrame], replies: DataFrame, tag: Column) -> DataFrame:
    """A reader's blocks in one form, with their flags; replies carry attempt, text, width, height."""
    key = F.struct("doc_id", "page", "attempt")
    named = replies.withColumn("_key", F.to_json(key))
    rows = read(named.select(F.col("_key").alias("doc_id"), "page", "attempt", "text", "width", "height", F.contains("text", F.lit("<<TRUNCATED>>")).alias("cut")))
    have = lambda c, kind: (F.col(c).cast(kind) if c in rows.columns else F.lit(None).cast(kind)).alias(c)
    where = F.from_json("doc_id", "doc_id string, page int, attempt int")
    out = rows.select(
        where["doc_id"].alias("doc_id"), where["page"].alias("page"), where["attempt"].alias("attempt"), "block_no", "type", "content", have("bbox", "array<double>"), tag.alias("source"), have("level", "int"),
        have("json_repaired", "boolean"), have("repeated", "int"), have("truncated_tail", "boolean"), F.lit(False).alias("tail_recovered"),
        F.when(F.col("bbox").isNotNull() & (F.col("type") == "figure"), crop_name(where["page"], F.col("block_no"))).alias("image"),
        F.when(F.col("bbox").isNotNull() & (F.col("type") == "figure"), F.concat(F.lit("Figure (page "), (where["page"] + 1).cast("string"), F.lit(")"))).alias("alt"),
        *(F.lit(None).cast("string").alias(c) for c in ("kind", "description", "description_error")),
        F.lit(None).cast("string").alias("reviewed"), F.lit(None).cast("string").alias("decision"), F.lit(None).cast("string").alias("previous"), F.lit(None).cast(HISTORY).alias("history"),
    )
    turns = replies.where("rotation > 0").select("doc_id", "page", "attempt", "rotation")
    out = out.join(turns, ["doc_id", "page", "attempt"], "left").withColumn("rotation", F.when(~F.coalesce("truncated_tail", F.lit(False)), F.col("rotation")))
    meta = F.struct("json_repaired", "repeated", "truncated_tail", "reviewed")
    return out.withColumn("flags", block_flags(F.col("type"), F.col("content"), meta))


def run(work: Work, stages: list[tuple[Callable, dict]]) -> int:
    """Stages in order; the exit code says how it ended. After a failed server or a stop, what
    was finished is saved and the rest stays to be done."""
    ship(work.spark)
    try:
        for stage, how in stages:
            stage(**how)
            work.check()
    except Stopped:
        return STOPPED
    except ServerDown:
        return STOPPED if work.stop() else FAILED
    except OSError as e:
        if models.system_error(e):
            return FAILED
        raise
    return DONE


def local(path: str) -> str:
    return path if "://" in path else os.path.abspath(path)
