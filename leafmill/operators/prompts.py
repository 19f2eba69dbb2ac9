"""REV-13 and the readers: what a model is asked, as column expressions.

An answer's form (the verdict line and the tag of each kind) is what `review.parsed` reads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.text import clean, data_url
from leafmill.operators.review import TAGS, issues, kind_of

SEEN = {"formula": "one displayed equation", "table": "one table", "text": "one region of a page"}
DRAFTED = {"formula": "LaTeX", "table": "HTML or Markdown", "text": "Markdown, mathematics between $ signs"}
LOOK = {
    "formula": "Go through it sign by sign: indices and exponents, primes and accents, Greek letters, operators, brackets and their sizes, fractions, alignment, and a number beside it, which stays as \\tag{...}.",
    "table": "Go through every cell, through cells that span rows or columns, and through mathematics, which stays between $ signs.",
    "text": "Go through the wording, the punctuation and every piece of mathematics.",
}
GIVE = {
    "formula": "Give the body of the LaTeX alone, without $ or \\[ \\] around it.",
    "table": "Give an HTML table if cells span rows or columns, else the form of the draft. Escapes and entities of the draft (&lt;, &amp;) stay as they are.",
    "text": "Give Markdown, mathematics between $ signs. Escapes (\\*, \\_, \\$, \\#) and entities (&lt;, &amp;) of the draft stay as they are: the image does not show them, but the text needs them.",
}
READ = {
    "formula": "the displayed equation in it, as the body of the LaTeX without $ or \\[ \\]; a number beside it becomes \\tag{...}",
    "table": "the table in it, as HTML if cells span rows or columns, else as Markdown, mathematics between $ signs",
    "text": "everything in it in the order of reading, as Markdown, mathematics between $ signs, displayed mathematics between $$ on lines of their own",
}
FAITH = "Write only what can be seen. Add, finish, shorten and improve nothing, and leave names, order and notation as they are, however odd."


def _by_kind(kind: Column, table: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), kind)


def review_prompt(block_type: Column, content: Column, flags: Column) -> Column:
    """The draft with what is flagged, to be proofread; or, without one, a part to be read."""
    kind, draft = kind_of(block_type), clean(content)
    tag = _by_kind(kind, TAGS)
    form = F.concat(F.lit("Answer in this form and no other:\nVERDICT: correct | fixed | unreadable\n<"), tag, F.lit(">\n...\n</"), tag, F.lit(">"))
    told = F.when(F.size(flags) > 0, F.concat(issues(flags), F.lit("\n"))).otherwise("")
    proof = F.concat(
        F.lit("This is proofreading of a page read by machine. The image shows "), _by_kind(kind, SEEN), F.lit(". The draft of it ("), _by_kind(kind, DRAFTED), F.lit(") is:\n\n<draft>\n"), draft,
        F.lit("\n</draft>\n"), told, F.lit("\nCompare the two. "), _by_kind(kind, LOOK), F.lit(f"\n{FAITH} A draft that is right already is given back unchanged.\n"), _by_kind(kind, GIVE), F.lit("\n\n"), form,
    )
    read = F.concat(
        F.lit("The image shows a part of a page of which the machine read nothing. Transcribe "), _by_kind(kind, READ), F.lit(f".\n{FAITH} Running heads, footers and page numbers are left out.\n"),
        F.lit("The verdict is `fixed` with a transcription; if there is nothing to transcribe it is `correct`, with nothing between the tags.\n\n"), form,
    )
    return F.when(draft != "", proof).otherwise(read)


FIGURE = """Describe this figure of a document for someone who cannot see it.
First line: KIND: one of plot, graph (vertices and edges), diagram, commutative_diagram, table_image, algorithm, photo, other.
Then <description>what it shows: axes and their ranges, curves and trends, parts and how they are connected, labels as they are written</description>.
Then, for a graph, diagram, commutative diagram or plot, <structure>...</structure>: a graph as one tikzpicture of \\node (name) at (x,y) {label}; and \\draw statements between named nodes; a commutative diagram as tikzcd; a diagram as Mermaid; a plot's points as text."""


def figure_prompt(caption: Column) -> Column:
    said = F.coalesce(F.trim(caption), F.lit(""))
    return F.when(said != "", F.concat(F.lit(FIGURE + "\nIts caption: "), said)).otherwise(FIGURE)


def with_problems(request: Column, problems: Column) -> Column:
    """A request made again, with what was wrong with its answer."""
    form = "struct<content:array<struct<type:string,image_url:struct<url:string>,text:string>>>"
    told = F.concat(F.lit("An earlier answer had these faults; give the whole answer again without them: "), F.array_join(problems, "; "))
    part = F.struct(F.lit("text").alias("type"), F.lit(None).cast("struct<url:string>").alias("image_url"), told.alias("text"))
    return F.to_json(F.struct(F.array_append(F.from_json(request, form)["content"], part).alias("content")))


def with_image(prompt: Column, image: Column, *more: Column) -> Column:
    """SNK-09: a request of an image and a text, as JSON for a chat endpoint; the text alone where
    there is no image. more: other fields of the request, null ones left out."""
    picture = F.struct(F.lit("image_url").alias("type"), F.struct(data_url(image).alias("url")).alias("image_url"), F.lit(None).cast("string").alias("text"))
    said = F.struct(F.lit("text").alias("type"), F.lit(None).cast("struct<url:string>").alias("image_url"), prompt.alias("text"))
    return F.to_json(F.struct(F.when(image.isNotNull(), F.array(picture, said)).otherwise(F.array(said)).alias("content"), *more))
