"""The text of a JSON record, with the field it came from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textmill.functions.text import strip

# Fixed value: the fields that may hold the text, by preference.
FIELDS = ["text", "content", "body", "article", "document", "paragraph", "description", "question", "answer", "title", "input", "output", "prompt", "completion", "metin", "icerik"]


def text_field(record: Column, field: str | None = None) -> Column:
    """struct(text, field) of a JSON object given as a string; null where it is none or has no text.

    An explicit field comes first (objects and lists as their JSON), then the first candidate with a non-blank
    string, then question and answer together, then the first string of over 20 characters in source order.
    """
    v = F.try_parse_json(record)
    kind = lambda x: F.schema_of_variant(x)
    quoted = lambda k: "$['" + k.replace("'", "\\'") + "']"
    at = lambda k: F.try_variant_get(v, quoted(k), "variant")
    as_text = lambda x: F.when(kind(x) == "STRING", F.try_variant_get(x, "$", "string"))
    out = lambda t, k: F.struct(t.alias("text"), (k if isinstance(k, Column) else F.lit(k)).alias("field"))
    steps = []
    if field:
        x = at(field)
        steps.append(F.when(strip(F.coalesce(as_text(x), F.lit(""))) != "", out(as_text(x), field)))
        steps.append(F.when(kind(x).startswith("OBJECT") | kind(x).startswith("ARRAY"), out(F.to_json(x), field)))
    for k in FIELDS:
        steps.append(F.when(strip(F.coalesce(as_text(at(k)), F.lit(""))) != "", out(as_text(at(k)), k)))
    keys = F.json_object_keys(record)
    q, a = (F.coalesce(F.try_variant_get(v, quoted(k), "string"), F.lit("")) for k in ("question", "answer"))
    both = F.array_contains(keys, "question") & F.array_contains(keys, "answer")
    steps.append(F.when(both, out(strip(F.concat(F.lit("Soru: "), q, F.lit("\nCevap: "), a)), "question+answer")))
    flat = F.from_json(record, "map<string,string>")
    strings = F.filter(keys, lambda k: (F.length(strip(F.coalesce(flat[k], F.lit("")))) > 20) & ~F.coalesce(flat[k], F.lit("")).rlike(r"\A[\[{]"))
    steps.append(F.when(F.size(strings) > 0, out(flat[strings[0]], strings[0])))
    return F.when(kind(v).startswith("OBJECT"), F.coalesce(*steps))
