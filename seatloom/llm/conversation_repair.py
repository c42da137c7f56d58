"""Conversation structure repair: the cheapest edits that make roles read ``(s?(ua)+)?``, by a fold in Spark SQL.

Windows flag each turn's faults, the turns of a conversation are collected as sorted structs, and ``aggregate`` folds them. The fold carries four
(cost, code) structs, one for each place in the pattern: nothing yet, after system, after user, after assistant. A place that can't be reached
is null, which ``least`` passes over. A code has one letter for each edit, in the order of the audit's initials, so ``least`` settles ties too: of codes with equal
cost and equally many turns none begins another, so the least beginning stays the least whatever follows.

The fold runs in two levels: within ``CHUNK`` turns a code has only its own letters and the rank of the beginning it continues, and whole codes are
joined once a chunk. Work thus stays near linear in a conversation's length. All rows of a conversation meet in one task, sorted and spillable, and one row
holds its turns: the audit and the hash are single values over all of them.

Edits: K keep 0; R make it user or assistant 2; D delete 3, required for blank and duplicate turns; I insert an empty turn 2. Truncated turns that stay add 1.

Defined cases: rows are taken by turn, nulls first, then role and text; null role and text are one space, so such a text is blank; a null conv_id is a
conversation; rows that repeat are duplicates of the first; a conversation without rows has zeros and an empty audit; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns of the inner fold.
CHUNK = 256
SPACE = " \t\n\x0b\x0c\r"
#: Letters of codes, in the order of the initials that they stand for: delete, insert user or assistant, keep, make it user or assistant.
DELETE, ADD_USER, ADD_ASSISTANT, KEEP, TO_USER, TO_ASSISTANT = "ABCDEF"
INITIALS = "DIIKRR"
PLACES = ("none", "system", "user", "assistant")


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults for the query: conv_id, turn, role, text, live; a dropped row stays with ``live`` false, so its conversation is known."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") != 0).alias("live"), copies).drop("copy")


def flagged(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, live) with ``nth`` (of equal role and text), ``fault``, ``illegal`` and ``fresh`` (first row of its turn)."""
    rows = rows.repartition("conv_id")  # serves every window and the collection
    order = F.asc_nulls_first("turn"), "role", "text"
    along, same = Window.partitionBy("conv_id", "live").orderBy(*order), Window.partitionBy("conv_id", "live", "role", "text").orderBy(order[0])
    end = F.substring(F.rtrim(F.col("text"), F.lit(SPACE)), -1, 1)
    initial = F.substring("role", 1, 1)
    before = F.lag(initial).over(along)
    fault = F.when(end == "", "blank").when(F.col("nth") > 1, "duplicate").when(~end.isin(".", "!", "?"), "truncated")
    return (
        rows.withColumn("nth", F.row_number().over(same))
        .withColumn("fault", fault)
        .withColumn("illegal", before.isNotNull() & ~F.concat(before, initial).isin("su", "ua", "au"))
        .withColumn("fresh", F.col("turn").isNotNull() & ~F.lag("turn").over(along).eqNullSafe(F.col("turn")))
    )


def let(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.transform(F.array(value), use)[0]


def added(place: Column, cost, code: str) -> Column:
    """A place's struct with one more edit; null stays null."""
    return F.when(place.isNotNull(), F.struct((place["cost"] + cost).alias("cost"), F.concat(place["code"], F.lit(code)).alias("code")))


def places(**by_name: Column) -> Column:
    return F.struct(*[by_name[p].alias(p) for p in PLACES])


def inserted(acc: Column) -> Column:
    """The four places after empty turns that may be inserted here."""
    user = F.least(acc["user"], *[added(acc[p], 2, ADD_USER) for p in ("none", "system", "assistant")])
    with_user = let(user, lambda u: places(none=acc["none"], system=acc["system"], user=u, assistant=F.least(acc["assistant"], added(u, 2, ADD_ASSISTANT))))
    return with_user


def step(acc: Column, turn: Column) -> Column:
    """The four places after one more turn."""
    stays = ~F.coalesce(turn["fault"].isin("blank", "duplicate"), F.lit(False))
    extra = F.when(turn["fault"] == "truncated", 1).otherwise(0)

    def after(at: Column) -> Column:
        def kept(initial: str, place: Column) -> Column:
            return F.when(stays & (turn["initial"] == initial), added(place, extra, KEEP))

        def turned(place: Column, code: str) -> Column:
            return F.when(stays, added(place, extra + 2, code))

        before_user = F.least(at["none"], at["system"], at["assistant"])
        dropped = {p: added(at[p], 3, DELETE) for p in PLACES}
        return places(
            none=dropped["none"],
            system=F.least(dropped["system"], kept("s", at["none"])),
            user=F.least(dropped["user"], kept("u", before_user), turned(before_user, TO_USER)),
            assistant=F.least(dropped["assistant"], kept("a", at["user"]), turned(at["user"], TO_ASSISTANT)),
        )

    return let(inserted(acc), after)


def cheapest(turns: Column, chunk: int = CHUNK) -> Column:
    """Sorted turns (structs with ``initial`` and ``fault``) -> struct of the least cost and its code."""
    kind = "struct<cost: bigint, code: string>"
    nothing = F.lit(None).cast(kind)
    start = places(none=F.struct(F.lit(0).cast("bigint").alias("cost"), F.lit("").alias("code")), system=nothing, user=nothing, assistant=nothing)

    def outer(acc: Column, n: Column) -> Column:
        def ranked(codes: Column) -> Column:
            def begun(place: Column) -> Column:
                rank = F.array_position(codes, place["code"]).cast("string")
                return F.when(place.isNotNull(), F.struct(place["cost"].alias("cost"), rank.alias("code")))

            def whole(place: Column) -> Column:
                code = F.concat(F.element_at(codes, F.substring(place["code"], 1, 1).cast("int")), F.substring(place["code"], 2, 1 << 30))
                return F.when(place.isNotNull(), F.struct(place["cost"].alias("cost"), code.alias("code")))

            inner = F.aggregate(F.slice(turns, n * chunk + 1, F.lit(chunk)), places(**{p: begun(acc[p]) for p in PLACES}), step)
            return let(inner, lambda x: places(**{p: whole(x[p]) for p in PLACES}))

        return let(F.array_sort(F.array_compact(F.array(*[acc[p]["code"] for p in PLACES]))), ranked)

    chunks = F.sequence(F.lit(0), F.floor(F.greatest(F.size(turns) - 1, F.lit(0)) / chunk).cast("int"))
    return let(F.aggregate(chunks, start, outer), lambda x: let(inserted(x), lambda y: F.least(y["none"], y["assistant"])))


def line(role, text, edit: str) -> Column:
    role, text = (F.lit(x) if isinstance(x, str) else x for x in (role, text))
    return F.struct(role.alias("role"), text.alias("text"), F.lit(edit).alias("edit"))


def lines_of(turns: Column, code: Column) -> Column:
    """Turns and their code -> the repaired turns, structs of role, text and edit."""

    def insertions(codes: Column) -> Column:
        letters = F.filter(F.split(codes, ""), lambda c: c != "")
        return F.transform(letters, lambda c: F.when(c == ADD_USER, line("user", "", "I")).otherwise(line("assistant", "", "I")))

    def edited(turn: Column, codes: Column) -> Column:
        own, text = F.substring(codes, -1, 1), turn["text"]
        as_is, no = F.array(line(turn["role"], text, "K")), F.array().cast("array<struct<role: string, text: string, edit: string>>")
        stays = F.when(own == KEEP, as_is).when(own == TO_USER, F.array(line("user", text, "R"))).when(own == TO_ASSISTANT, F.array(line("assistant", text, "R"))).otherwise(no)
        return F.concat(insertions(F.regexp_extract(codes, "^[BC]*", 0)), stays)

    for_turns = F.regexp_extract_all(code, F.lit("[BC]*[ADEF]"), F.lit(0))
    return F.concat(F.flatten(F.zip_with(turns, for_turns, edited)), insertions(F.regexp_extract(code, r"[BC]*\z", 0)))


def repair(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Conversations -> conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, and ``lines``: the repaired turns (role, text, edit).

    Where there is a boolean column ``live``, rows in which it is false count as missing.
    """
    live = F.col("live") if "live" in conversations.columns else F.lit(True)
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = flagged(conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), live.alias("live")))
    turn = F.struct("turn", "role", "text", "nth", "fault", F.substring("role", 1, 1).alias("initial"))
    counted = {c: F.count(F.when(F.col("live") & (F.col("fault") == c), 1)).alias(c) for c in ("blank", "duplicate", "truncated")}
    alive = F.when(F.col("live"), F.col("turn"))
    gaps = F.max(alive) - F.min(alive) + 1 - F.count(F.when(F.col("live") & F.col("fresh"), 1))
    found = rows.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *counted.values(),
        F.count(F.when(F.col("live") & F.col("illegal"), 1)).alias("illegal"), F.sort_array(F.collect_list(F.when(F.col("live"), turn))).alias("turns"),
    )
    best = found.withColumn("best", cheapest(F.col("turns"), chunk))
    return best.select(
        "conv_id", "gaps", *counted, "illegal", F.col("best.cost").alias("cost"), F.translate("best.code", "ABCDEF", INITIALS).alias("audit"),
        lines_of(F.col("turns"), F.col("best.code")).alias("lines"),
    )


def repaired(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Conversations -> conv_id, turn (from 0), role, text, edit: one row for each turn after repair."""
    rows = repair(conversations, chunk).select("conv_id", F.posexplode("lines").alias("turn", "line"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "line.role", "line.text", "line.edit")


def digest(found: DataFrame) -> DataFrame:
    """``repair``'s rows with a hash of the repaired turns in place of them."""
    joined = F.array_join(F.transform("lines", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
    return found.withColumn("repaired_sha256", F.sha2(joined, 256)).drop("lines")


def _oracle() -> str:
    """The same in SQL, row by row in a recursive query; a place is its cost in six digits, then its code."""
    add = lambda x, cost, code: f"(lpad((left({x}, 6)::INTEGER + {cost})::VARCHAR, 6, '0') || substr({x}, 7) || '{code}')"
    inserted = lambda rows: f"(SELECT * REPLACE (least(a, {add('u', 2, 'C')}) AS a) FROM (SELECT * REPLACE (least(u, {add('e', 2, 'B')}, {add('s', 2, 'B')}, {add('a', 2, 'B')}) AS u) FROM {rows}))"
    stays = "coalesce(fault, '') NOT IN ('blank', 'duplicate')"
    keep = lambda initial, x: f"CASE WHEN {stays} AND left(role, 1) = '{initial}' THEN {add(x, 'more', 'D')} END"
    turn = lambda x, code: f"CASE WHEN {stays} THEN {add(x, 'more + 2', code)} END"
    first = "least(e, s, a)"
    return rf"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
kinds AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(name, ''), lambda c: ascii(c)::BIGINT)),
          lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295::BIGINT) % 20 AS kind FROM named, crc),
damaged AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds),
told AS (SELECT *, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last_one,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM damaged),
ended AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS i FROM told),
flagged AS (SELECT *, CASE WHEN last_one = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN last_one NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
            lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM ended),
turns AS (SELECT conv_id AS t_conv, i AS t_i, role, text, fault, pair, turn, coalesce(fault = 'truncated', false)::INTEGER AS more FROM flagged),
counted AS (SELECT c.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
            count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(i) AS n
            FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN flagged f ON c.conv_id IS NOT DISTINCT FROM f.conv_id GROUP BY c.conv_id),
places(conv_id, i, e, s, u, a) AS (
  SELECT conv_id, 0::BIGINT, '000000', NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM counted
  UNION ALL
  SELECT conv_id, t_i, {add('e', 3, 'A')}, least({add('s', 3, 'A')}, {keep('s', 'e')}),
         least({add('u', 3, 'A')}, {keep('u', first)}, {turn(first, 'E')}), least({add('a', 3, 'A')}, {keep('a', 'u')}, {turn('u', 'F')})
  FROM {inserted('places')} JOIN turns ON conv_id IS NOT DISTINCT FROM t_conv AND t_i = i + 1),
best AS (SELECT p.conv_id, least(e, a) AS b FROM {inserted('places')} p JOIN counted c ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.i = c.n),
codes AS (SELECT conv_id, left(b, 6)::BIGINT AS cost, substr(b, 7) AS code FROM best),
pieces AS (SELECT conv_id, unnest(regexp_extract_all(code, '[BC]*[ADEF]')) AS piece, generate_subscripts(regexp_extract_all(code, '[BC]*[ADEF]'), 1) AS p_i FROM codes),
written AS (SELECT conv_id, string_agg(replace(replace(regexp_extract(piece, '^[BC]*'), 'B', 'user:' || chr(10)), 'C', 'assistant:' || chr(10)) ||
            CASE right(piece, 1) WHEN 'A' THEN '' WHEN 'D' THEN role || ':' || text || chr(10) WHEN 'E' THEN 'user:' || text || chr(10) ELSE 'assistant:' || text || chr(10) END, '' ORDER BY p_i) AS w
            FROM pieces JOIN turns ON conv_id IS NOT DISTINCT FROM t_conv AND p_i = t_i GROUP BY conv_id),
whole AS (SELECT k.conv_id, cost, code, coalesce(w, '') || replace(replace(regexp_extract(code, '[BC]*$'), 'B', 'user:' || chr(10)), 'C', 'assistant:' || chr(10)) AS w
          FROM codes k LEFT JOIN written x ON k.conv_id IS NOT DISTINCT FROM x.conv_id)
SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, cost, translate(code, 'ABCDEF', '{INITIALS}') AS audit, sha256(substr(w, 1, greatest(length(w) - 1, 0))) AS repaired_sha256
FROM counted c JOIN whole w ON c.conv_id IS NOT DISTINCT FROM w.conv_id
"""


ORACLE_SQL = _oracle()
