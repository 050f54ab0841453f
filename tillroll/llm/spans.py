"""Spans of regular expressions in whole texts, in DataFrame functions only.

Positions count code points, ends are exclusive.  Texts are cut at the
matches: the pieces between them give the positions, and what stands before
and after each match, at a cost in proportion to the text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Characters kept before and after a match.
BEFORE, AFTER = 48, 16
#: Elements of an array that are worked through together.
CHUNK = 256
SPAN = "array<struct<start:bigint,end:bigint,s:string,before:string,after:string>>"


def let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def chunks(values: Column) -> Column:
    """The array cut into arrays of CHUNK elements."""
    n = F.size(values)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int")),
                                     lambda c: F.slice(values, c * CHUNK + 1, F.lit(CHUNK)))).otherwise(F.array(values))


def running_sums(values: Column) -> Column:
    """0, the first value, the sum of the first two, ... of an array of longs.

    An array is copied when an element is added to it; so sums run within
    chunks, and over the chunks: the work per element does not grow with the
    elements before, but for one sum a chunk.
    """
    def run(of: Column) -> Column:
        return F.aggregate(of, F.array(F.lit(0).cast("bigint")),
                           lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))

    def join(x: Column) -> Column:
        totals = run(F.transform(x["c"], lambda c: F.element_at(c, -1)))
        return let(F.struct(x["c"].alias("c"), totals.alias("t")), lambda y: F.concat(
            F.array(F.lit(0).cast("bigint")),
            F.flatten(F.transform(y["c"], lambda c, i: F.transform(
                F.slice(c, F.lit(2), F.size(c)), lambda v: v + F.get(y["t"], i))))))

    return let(F.struct(F.transform(chunks(values), run).alias("c")), join)


def find(text: Column, pattern: str, guard: Column | None = None) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` as an array of structs
    (start, end, s, before, after).  ``guard`` false says there are none."""
    none = F.array().cast(SPAN)

    def cut(x: Column) -> Column:
        return let(F.struct(x["m"].alias("m"), F.split(x["t"], pattern, -1).alias("p")), place)

    def place(x: Column) -> Column:
        m, p = x["m"], x["p"]
        ends = running_sums(F.transform(m, lambda s, i: (F.length(F.get(p, i)) + F.length(s)).cast("bigint")))
        return let(F.struct(m.alias("m"), p.alias("p"), ends.alias("e")), lambda y: F.transform(
            y["m"], lambda s, i: F.struct(
                (y["e"][i + 1] - F.length(s)).alias("start"), y["e"][i + 1].alias("end"), s.alias("s"),
                F.right(y["p"][i], F.lit(BEFORE)).alias("before"),
                F.left(y["p"][i + 1], F.lit(AFTER)).alias("after"))))

    found = let(F.struct(text.alias("t"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m")),
                lambda x: F.when(F.size(x["m"]) > 0, cut(x)).otherwise(none))
    return found if guard is None else F.when(guard, found).otherwise(none)


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(number)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def apart(found: Column, others: Column) -> Column:
    """The spans of ``found`` that overlap none of ``others``, which are held
    chunk by chunk: only chunks that reach to a span are looked into."""
    def reach(c: Column) -> Column:
        return F.struct(F.array_min(F.transform(c, lambda b: b["start"])).alias("start"),
                        F.array_max(F.transform(c, lambda b: b["end"])).alias("end"), c.alias("spans"))

    def overlap(c: Column, b: Column) -> Column:
        return (b["start"] < c["end"]) & (c["start"] < b["end"])

    def free(x: Column) -> Column:
        return F.filter(x["f"], lambda c: ~F.exists(x["o"], lambda part: F.coalesce(
            overlap(c, part) & F.exists(part["spans"], lambda b: overlap(c, b)), F.lit(False))))

    return F.when((F.size(found) > 0) & (F.size(others) > 0), let(F.struct(
        found.alias("f"), F.transform(chunks(others), reach).alias("o")), free)).otherwise(found)


def joined(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` by start, then kind in the order of ``kinds``."""
    names = F.array(*[F.lit(k) for k in kinds])
    order = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def masked(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with every span, overlapping ones merged, replaced by ``mask``."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    def merge(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        return F.when(s["start"] < last["end"], F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        ).otherwise(F.concat(acc, F.array(s)))

    zero = F.lit(0).cast("bigint")
    merged = F.aggregate(order, F.array(F.struct(zero.alias("start"), zero.alias("end"))), merge)

    def between(x: Column) -> Column:
        return F.array_join(F.transform(x["m"], lambda s, i: F.substring(
            x["t"], (s["end"] + 1).cast("int"),
            F.coalesce(F.get(x["m"], i + 1)["start"], F.length(x["t"]).cast("bigint")).cast("int") - s["end"].cast("int"))), mask)

    return F.when(F.size(spans) > 0, let(F.struct(text.alias("t"), merged.alias("m")), between)).otherwise(text)
