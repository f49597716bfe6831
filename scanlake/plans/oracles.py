"""The registered queries as DuckDB SQL over the same tables, for checking results."""

from __future__ import annotations

FILES = """
files as (
  select doc_id as id, file_path, regexp_replace(file_path, '^.*/', '') as file_name,
         case when doc_id % 17 <> 0 then n_chars end as file_size_bytes, lang
  from (select *, concat(case when doc_id % 13 = 0 then '/other/' when doc_id % 7 = 0 then '/scans/'
                              else concat('/scans/', lang, '/', source, '/') end,
                         'doc_', lpad(cast(doc_id as varchar), 12, '0'),
                         case doc_id % 5 when 0 then '.tif' when 1 then '.tiff' when 2 then '.TIF'
                                         when 3 then '.jpg' else '.tar.tiff' end) as file_path
        from documents))"""

LEDGER = (
    FILES
    + """,
ledger as (
  select id, file_path, file_name, file_size_bytes, status,
         case when held then concat('host-', id % 4) end as worker_id,
         case when held then started end as started_at,
         case when status = 'complete' then started + to_seconds(id % 7 + 1) end as completed_at,
         case when status = 'failed' then 'disk full' end as error_message,
         cast(case when status = 'failed' then 3 else (id // 10) % 4 end as integer) as retry_count,
         cast(null as varchar) as output_path, cast(null as integer) as page_count
  from (select *, timestamp '2024-01-01 00:00:00' + to_seconds(id * 37) as started,
               id % 10 < 5 or id % 10 in (7, 8) as held,
               case when id % 10 < 5 then 'complete' when id % 10 < 7 then 'pending'
                    when id % 10 < 9 then 'processing' else 'failed' end as status
        from files))"""
)

TEXT_PAGES = (
    FILES
    + """,
text_pages as (
  select image_id, file_path, file_size_bytes, cast(p as integer) as page_number, l[p] as text
  from (select *, unnest(range(1, len(l) + 1)) as p
        from (select doc_id as image_id, f.file_path, f.file_size_bytes,
                     string_split(concat(chr(10), text, chr(10)), chr(10)) as l
              from documents join files f on f.id = doc_id)))"""
)

RECOGNISED = (
    TEXT_PAGES
    + """,
recognised as (
  select *, ((image_id * 13 + page_number * 29) % 101) / 100.0::double as confidence,
         cast((image_id * 7 + page_number * 3) % 2000 as integer) as processing_time_ms,
         case image_id % 3 when 0 then 'tesseract' when 1 then 'easyocr' else 'paddleocr' end as ocr_engine,
         cast(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) as integer) as word_count,
         cast(length(text) as integer) as char_count
  from text_pages)"""
)

TOKENS = (
    TEXT_PAGES
    + """,
tokens as (
  select image_id, page_number, cast(k as integer) as token_no, l[k] as text,
         cast((image_id * 31 + page_number * 7 + k * 13) % 102 - 1 as integer) as conf
  from (select *, unnest(range(1, len(l) + 1)) as k
        from (select image_id, page_number, string_split(text, ' ') as l from text_pages))
  where l[k] <> '')"""
)

OUTCOMES = (
    LEDGER
    + """,
outcomes as (
  select id, case when id % 2 = 1 then repeat('e', cast(3990 + id % 20 as integer)) end as error_message,
         case when id % 2 = 0 then concat('/out/', file_name) end as output_path,
         case when id % 2 = 0 then cast(id % 9 + 1 as integer) end as page_count
  from ledger where status = 'processing')"""
)

KNOWN = LEDGER + ", known as (select * from ledger where id in (select doc_id from labels))"
POOR = ", poor as (select doc_id as image_id from labels where quality = 0)"
PURGED = ", remaining as (select id from ledger where status <> 'failed')"

PLACED = (
    FILES
    + """,
parts as (
  select *, case when starts_with(file_path, '/scans/') then substr(file_path, 8) else file_name end as rel,
         regexp_replace(file_name, '\\.[^.]+$', '') as stem
  from files),
placed as (
  select *, concat('/out/', left(rel, length(rel) - length(file_name)), stem) as output_base from parts)"""
)

GRID_LINES = """
lines as (
  select (vec_id // 64) // 4 as image_id, cast((vec_id // 64) % 4 + 1 as integer) as page_number,
         cast(vec_id % 64 as integer) as y,
         list_transform(embedding, lambda e: cast(floor((cast(e as double) + 1) * 127.5) as integer)) as l
  from embeddings),
grid as (
  select image_id, page_number, y, cast(k - 1 as integer) as x, l[k] as v
  from (select *, unnest(range(1, len(l) + 1)) as k from lines)),
grid_pages as (
  select image_id, page_number, max(len(l)) as width, max(y) + 1 as height from lines group by all),
colour as (
  select image_id, page_number, y, cast(k - 1 as integer) as x, l[k] as r,
         l[k % len(l) + 1] as g, l[(k + 1) % len(l) + 1] as b
  from (select *, unnest(range(1, len(l) + 1)) as k from lines)),
colour_gray as (
  select image_id, page_number, y, x, (r * 19595 + g * 38470 + b * 7471 + 32768) >> 16 as v from colour)"""

DPI_PAGES = """
dpi_pages as (
  select p_partkey as id, p_size * 100 as width, p_size * 60 as height,
    case p_partkey % 12 when 0 then ['150','160'] when 1 then ['0','160'] when 2 then ['150','0']
      when 3 then ['150'] when 4 then ['0'] when 5 then ['200'] when 6 then ['-5']
      when 7 then ['invalid'] when 8 then cast([] as varchar[]) when 9 then ['5']
      when 10 then ['1300'] end as dpi
  from part),
numbered as (
  select *, try_cast(dpi[1] as double) as a,
         case when len(dpi) >= 2 then try_cast(dpi[2] as double) else try_cast(dpi[1] as double) end as b
  from dpi_pages),
parsed as (
  select *, case when a > 0 and b > 0 then a else 300.0::double end as x_dpi,
         case when a > 0 and b > 0 then b else 300.0::double end as y_dpi from numbered)"""

CONFIDENCE = "case when {n} > 0 then (({s} * 200 + {n}) // (2 * {n})) / 10000.0::double else 0.0::double end"


def _otsu(source: str, prefix: str) -> str:
    """CTEs giving {prefix}_threshold(image_id, page_number, threshold)."""
    return f"""
{prefix}_h as (select image_id, page_number, v, count(*) as n from {source} group by all),
{prefix}_k as (
  select image_id, page_number, v,
         cast(sum(n) over upto as double) as w1, cast(sum(n * v) over upto as double) as s1,
         cast(sum(n) over page as double) as w, cast(sum(n * v) over page as double) as s
  from {prefix}_h
  window upto as (partition by image_id, page_number order by v rows unbounded preceding),
         page as (partition by image_id, page_number)),
{prefix}_b as (
  select *, case when w1 < w then w1 * (w - w1) * (s1 / w1 - (s - s1) / (w - w1)) * (s1 / w1 - (s - s1) / (w - w1))
                 else -1 end as variance from {prefix}_k),
{prefix}_threshold as (
  select image_id, page_number, v as threshold from
    (select *, row_number() over (partition by image_id, page_number order by variance desc, v) as r from {prefix}_b)
  where r = 1)"""


def _skew(source: str, prefix: str) -> str:
    """CTEs giving {prefix}_angle(image_id, page_number, angle)."""
    return f"""{_otsu(source, prefix)},
{prefix}_m as (
  select image_id, page_number, count(*) filter (v < threshold) as n,
         sum(y) filter (v < threshold) as sy, sum(x) filter (v < threshold) as sx,
         sum(y * y) filter (v < threshold) as syy, sum(x * x) filter (v < threshold) as sxx,
         sum(x * y) filter (v < threshold) as sxy
  from {source} join {prefix}_threshold using (image_id, page_number) group by all),
{prefix}_a as (
  select image_id, page_number, n, degrees(0.5 * atan2(2.0 * cast(n * sxy - sx * sy as double),
         cast((n * sxx - sx * sx) - (n * syy - sy * sy) as double))) as a from {prefix}_m),
{prefix}_angle as (
  select image_id, page_number, case when n < 5 then 0.0 when a > 45 then a - 90 when a < -45 then a + 90
                                     else a end as angle from {prefix}_a)"""


def _resample(source: str, plan: str, prefix: str, values: tuple[str, ...]) -> str:
    """CTEs giving {prefix}_grid; weights per (old size, new size, target, source) as a table."""
    sums = ", ".join(f"sum(u * {v}) as w_{v}" for v in values)
    shown = ", ".join(
        f"cast(least(greatest((2 * w_{v} + w) // (2 * w), 0), 255) as integer) as {v}" for v in values
    )

    def one_pass(name: str, cells: str, axis: str, other: str, size: str, new: str) -> str:
        return f"""
{name} as (
  select image_id, page_number, {other}, {axis}, {shown} from (
    select c.image_id, c.page_number, c.{other}, w.d as {axis}, sum(u) as w, {sums}
    from {cells} c join {plan} p using (image_id, page_number)
    join {prefix}_w w on w.n_in = p.{size} and w.n_out = p.{new} and w.src = c.{axis}
    group by all))"""

    return f"""
{prefix}_sizes as (
  select width as n_in, new_width as n_out from {plan} union select height, new_height from {plan}),
{prefix}_c as (
  select n_in, n_out, d, n_in / n_out as step, greatest(n_in / n_out, 1.0) as stretch,
         (d + 0.5) * (n_in / n_out) as centre
  from (select n_in, n_out, unnest(range(0, n_out)) as d from {prefix}_sizes)),
{prefix}_t as (
  select *, (src + 0.5 - centre) / stretch as t from (
    select *, unnest(range(cast(greatest(floor(centre - stretch * 3.0 + 0.5), 0) as bigint),
                           cast(least(floor(centre + stretch * 3.0 + 0.5), n_in) as bigint))) as src
    from {prefix}_c)),
{prefix}_w as (
  select n_in, n_out, cast(d as integer) as d, src, cast(floor(0.5 + 4194304 * case when n_in = n_out then (d = src)::integer
         when t = 0 then 1.0 when abs(t) < 3
         then 3.0 * sin(3.141592653589793 * t) * sin(3.141592653589793 * t / 3.0)
              / ((3.141592653589793 * t) * (3.141592653589793 * t)) else 0.0 end) as bigint) as u
  from {prefix}_t where n_in <> n_out or d = src),
{one_pass(prefix + "_wide", source, "x", "y", "width", "new_width")},
{one_pass(prefix + "_grid", prefix + "_wide", "y", "x", "height", "new_height")}"""


def _rotate(source: str, angles: str, prefix: str) -> str:
    """CTEs giving {prefix}_grid: every target cell gathers its 16 neighbours."""
    return f"""
{prefix}_i as (
  select s.*, coalesce(a.angle, 0.0) as angle, cos(radians(coalesce(a.angle, 0.0))) as c,
         sin(radians(coalesce(a.angle, 0.0))) as s
  from (select image_id, page_number, max(x) + 1 as width, max(y) + 1 as height, min(v) as v_min, max(v) as v_max
        from {source} group by all) s left join {angles} a using (image_id, page_number)),
{prefix}_f as (
  select *, c * dx - s * dy + mx as fx, s * dx + c * dy + my as fy from (
    select i.*, g.x, g.y, width / 2.0 - 0.5 as mx, height / 2.0 - 0.5 as my,
           g.x - (width / 2.0 - 0.5) as dx, g.y - (height / 2.0 - 0.5) as dy
    from {source} g join {prefix}_i i using (image_id, page_number))),
{prefix}_n as (
  select f.*, kx, ky, fx - kx as tx, fy - ky as ty from {prefix}_f f,
    lateral (select cast(floor(fx) as integer) + unnest(range(-1, 3)) as kx) a,
    lateral (select cast(floor(fy) as integer) + unnest(range(-1, 3)) as ky) b),
{prefix}_u as (
  select n.*, g.v, cast(floor(0.5 + 4194304 * (
      case when abs(tx) < 1 then (abs(tx) * 1.5 - 2.5) * abs(tx) * abs(tx) + 1.0
           when abs(tx) < 2 then ((abs(tx) * -0.5 + 2.5) * abs(tx) - 4.0) * abs(tx) + 2.0 else 0.0 end *
      case when abs(ty) < 1 then (abs(ty) * 1.5 - 2.5) * abs(ty) * abs(ty) + 1.0
           when abs(ty) < 2 then ((abs(ty) * -0.5 + 2.5) * abs(ty) - 4.0) * abs(ty) + 2.0 else 0.0 end
    )) as bigint) as u
  from {prefix}_n n left join {source} g
    on g.image_id = n.image_id and g.page_number = n.page_number and g.x = kx and g.y = ky),
{prefix}_s as (
  select image_id, page_number, y, x, any_value(fx) as fx, any_value(fy) as fy, any_value(width) as width,
         any_value(height) as height, any_value(v_min) as v_min, any_value(v_max) as v_max,
         any_value(angle) as angle, coalesce(cast(sum(u * v) as bigint), 0) as wv,
         coalesce(cast(sum(u) filter (v is not null) as bigint), 0) as w
  from {prefix}_u group by image_id, page_number, y, x),
{prefix}_v as (
  select *, case when angle = 0 or (floor(fx) >= 1 and ceil(fx) + 1 < width and floor(fy) >= 1
                                    and ceil(fy) + 1 < height and w > 0)
                 then wv // w else (wv + (4194304 - w) * 255) // 4194304 end as value from {prefix}_s),
{prefix}_grid as (
  select image_id, page_number, y, x,
         cast(case when value = 255 then 255 else least(greatest(value, v_min), v_max) end as integer) as v
  from {prefix}_v)"""


def _sauvola(source: str, prefix: str) -> str:
    """CTEs giving {prefix}_grid: mirrored padding, two window passes over whole pages."""

    def mirrored(p: str, size: str) -> str:
        wrapped = f"((({p}) % (2 * ({size}) - 2) + (2 * ({size}) - 2)) % (2 * ({size}) - 2))"
        return (
            f"case when {size} = 1 then 0 when {wrapped} < {size} then {wrapped} "
            f"else 2 * ({size}) - 2 - {wrapped} end"
        )

    return f"""
{prefix}_z as (
  select image_id, page_number, max(x) + 1 as width, max(y) + 1 as height from {source} group by all),
{prefix}_px as (
  select *, {mirrored("px", "width")} as sx from (
    select *, unnest(range(-12, width + 12)) as px from {prefix}_z)),
{prefix}_py as (
  select *, {mirrored("py", "height")} as sy from (
    select *, unnest(range(-12, height + 12)) as py from {prefix}_z)),
{prefix}_pad as (
  select g.image_id, g.page_number, px, py, a.width, a.height, v, cast(v as bigint) * v as vv
  from {source} g join {prefix}_px a on a.image_id = g.image_id and a.page_number = g.page_number and a.sx = g.x
  join {prefix}_py b on b.image_id = g.image_id and b.page_number = g.page_number and b.sy = g.y),
{prefix}_r as (
  select *, sum(v) over r as s1, sum(vv) over r as s2, count(*) over r as n from {prefix}_pad
  window r as (partition by image_id, page_number, py order by px range between 12 preceding and 12 following)),
{prefix}_q as (
  select *, cast(sum(s1) over c as double) as t1, cast(sum(s2) over c as double) as t2,
         cast(sum(n) over c as double) as tn
  from {prefix}_r
  window c as (partition by image_id, page_number, px order by py range between 12 preceding and 12 following)),
{prefix}_grid as (
  select image_id, page_number, cast(py as integer) as y, cast(px as integer) as x,
         case when v > (t1 / tn) * (1.0 + 0.2 * (sqrt(greatest(t2 / tn - (t1 / tn) * (t1 / tn), 0.0)) / 127.5 - 1.0))
              then 255 else 0 end as v
  from {prefix}_q where px between 0 and width - 1 and py between 0 and height - 1)"""


PAGE_PLAN = """
page_plan as (
  select *, case when resized then cast(width * 2 as integer) else width end as new_width,
         case when resized then cast(height * 2 as integer) else height end as new_height
  from (select *, (image_id + page_number) % 3 = 0 as resized from grid_pages))"""

TURNS = """
turns as (
  select image_id, page_number, cast((image_id * 4 + page_number) * 5 % 19 - 9 as double) as angle
  from grid_pages)"""

PREP = f"""{GRID_LINES},{PAGE_PLAN},{_resample("colour", "page_plan", "rs", ("r", "g", "b"))},
gray as (
  select image_id, page_number, y, x, (r * 19595 + g * 38470 + b * 7471 + 32768) >> 16 as v from rs_grid),
{_skew("gray", "sk")},
turning as (select * from sk_angle where abs(angle) >= 0.5)"""

# Documents that recognition cannot read in run_rounds.
ROUNDS = (
    LEDGER
    + """,
fresh as (
  select *, status = 'processing' and started_at < timestamp '2024-01-01 05:00:00' as stale,
         id in (select doc_id from labels where toxic = 1) as bad
  from ledger),
queued as (
  select *, retry_count + stale::integer as tries,
         (status = 'pending' or stale) and retry_count + stale::integer < 3 as run
  from fresh)"""
)


def _with(ctes: str, select: str) -> str:
    return f"with {ctes.strip()}\n{select.strip()}"


def _and(first: str, *more: str) -> str:
    """CTE lists that all start with the files view, put together with one copy of it."""
    return first + "".join(ctes.removeprefix(FILES) for ctes in more)


def _join_tokens(separator: str, text: str) -> str:
    return _with(
        TOKENS,
        f"""
        select p.image_id, p.page_number, coalesce(t.text, '') as text,
               coalesce({CONFIDENCE.format(n="t.n", s="t.s")}, 0.0) as confidence
        from text_pages p left join (
          select image_id, page_number, string_agg({text}, {separator} order by token_no) as text,
                 sum(conf) filter (conf >= 0 and {text} is not null) as s,
                 count(*) filter (conf >= 0 and {text} is not null) as n
          from tokens group by all) t using (image_id, page_number)""",
    )


# Columns shown with -1 instead of null; see catalog._no_nulls.
NO_NULLS = {
    "scan_files": "file_size_bytes", "scan_flat": "file_size_bytes", "register_new": "file_size_bytes",
    "document_index": "file_size_bytes", "mark_complete": "page_count", "isolate_errors": "page_count",
    "run_rounds": "page_count",
}


def oracle_sql() -> dict[str, str]:
    sql = _oracle_sql()
    for name, column in NO_NULLS.items():
        sql[name] = f"select * replace (coalesce({column}, -1) as {column}) from (\n{sql[name]}\n)"
    sql["run_job"] = f"""
        select * exclude (output_path), output_path is not null as on_disk,
               cast(case when output_path is not null then page_count else 0 end as bigint) as n_results
        from ({sql["run_rounds"]})"""
    return sql


def _oracle_sql() -> dict[str, str]:
    moved = "case when stale then {0} else {1} end"
    done = "o.id is not null and o.error_message is null"
    bad = "o.error_message is not null"
    status_bad = "case when retry_count + 1 >= 3 then 'failed' else 'pending' end"
    separator = "concat(chr(10), chr(10), '--- Page Break ---', chr(10), chr(10))"
    full_text = f"coalesce(string_agg(nullif(text, ''), {separator} order by page_number), '')"
    ocr_words = "regexp_split_to_array(text, '\\s+')"
    doc_rows = _with(
        _and(RECOGNISED, PLACED),
        f"""
        select image_id, p.file_path as source_path, p.file_name,
               p.rel as relative_path, p.output_base, p.file_size_bytes,
               cast(count(*) as integer) as page_count, {full_text} as full_text,
               cast(sum(word_count) as integer) as word_count,
               {CONFIDENCE.format(n="count(*)", s="cast(sum((image_id * 13 + page_number * 29) % 101) as bigint)")} as confidence,
               'tesseract' as ocr_engine, 'eng' as ocr_language, '--oem 1 --psm 3' as ocr_config,
               false as preprocessing_enabled, '2024-01-01T06:00:00+00:00' as processed_at,
               cast(sum(processing_time_ms) as bigint) as total_processing_time_ms
        from recognised r join placed p on p.id = r.image_id
        group by image_id, p.file_path, p.file_name, p.rel, p.output_base,
                 p.file_size_bytes""",
    )
    placed_pages = _and(RECOGNISED, PLACED)
    text_files = placed_pages + f""",
      texts as (
        select concat(substr(any_value(output_base), 5), '-', image_id) as name,
               {full_text} as body, count(*) as pages
        from recognised join placed on id = image_id group by image_id)"""
    return {
        "scan_files": _with(FILES, """
            select file_path, file_name, file_size_bytes from files
            where file_path like '/scans/%' and regexp_matches(lower(file_name), '\\.(tif|tiff)$')"""),
        "scan_flat": _with(FILES, """
            select file_path, file_name, file_size_bytes from files
            where file_path like '/scans/%' and file_path not like '/scans/%/%'
              and regexp_matches(lower(file_name), '\\.(tif|tiff)$')"""),
        "filter_ext": _with(FILES, """
            select id, regexp_extract(file_name, '\\.[^.]+$') as suffix,
                   lower(regexp_extract(file_name, '\\.[^.]+$')) in ('.tif', '.jpg') as wanted from files"""),
        "register_new": _with(KNOWN, """
            select (select coalesce(max(id), 0) from known) + row_number() over (order by file_path) as id,
                   file_path, file_name, file_size_bytes, 'pending' as status,
                   cast(0 as integer) as retry_count, timestamp '2024-01-01 06:00:00' as created_at
            from files where file_path not in (select file_path from known)"""),
        "init_ledger": _with(FILES, """
            select row_number() over (order by file_path) as id, file_path, file_name, 'pending' as status,
                   cast(0 as integer) as retry_count, timestamp '2024-01-01 06:00:00' as created_at
            from files"""),
        "register_stats": _with(KNOWN, """
            select count(*) as discovered,
                   count(*) filter (file_path not in (select file_path from known)) as registered,
                   count(*) filter (file_path in (select file_path from known)) as skipped from files"""),
        "relative_path": _with(PLACED, "select id, rel as relative_path from placed"),
        "output_base": _with(PLACED, "select id, stem, output_base from placed"),
        "output_plan": _with(PLACED, """
            select file_path, output_base, format, concat(output_base, '.', format) as output_path
            from placed, (values ('pdf'), ('txt'), ('json')) f(format)"""),
        "output_collisions": _with(PLACED, """
            select output_base, count(*) as n from (
              select file_path, output_base from placed union
              select concat(left(file_path, length(file_path) - length(file_name)), stem, '.tiff'), output_base
              from placed)
            group by output_base having count(*) > 1"""),
        "status_counts": _with(LEDGER, "select status, count(*) as n from ledger group by status"),
        "progress": _with(LEDGER, """
            select count(*) as total, count(*) filter (status = 'complete') as complete,
                   count(*) filter (status = 'pending') as pending,
                   count(*) filter (status = 'processing') as processing,
                   count(*) filter (status = 'failed') as failed,
                   coalesce(count(*) filter (status = 'complete') * 100.0::double / nullif(count(*), 0), 0)
                     as percent_complete
            from ledger"""),
        "status_summary": _with(LEDGER, """
            select status, count(*) as image_count, sum(file_size_bytes) / 1073741824.0::double as total_size_gb,
                   cast(sum(date_diff('microsecond', started_at, completed_at)) as double)
                     / (count(completed_at) * 1000.0::double) as avg_processing_ms
            from ledger group by status"""),
        "failed_list": _with(LEDGER, """
            select file_path, retry_count, error_message from ledger where status = 'failed' order by file_path"""),
        "eligible": _with(LEDGER, """
            select id, file_path, retry_count from ledger where status = 'pending' and retry_count < 3"""),
        "queue_empty": _with(LEDGER, """
            select count(*) = 0 as queue_empty from ledger where status = 'pending' and retry_count < 3"""),
        "exhausted_pending": _with(LEDGER, """
            select id, file_path, retry_count from ledger where status = 'pending' and retry_count >= 3"""),
        "worker_stats": _with(OUTCOMES, """
            select worker_id, count(*) filter (o.error_message is null) as processed,
                   count(*) filter (o.error_message is not null) as errors
            from ledger join outcomes o using (id) group by worker_id"""),
        "claim_batch": _with(LEDGER, """
            select id, file_path, file_name, case when n is null then status else 'processing' end as status,
                   case when n is null then worker_id else ['host-a', 'host-b', 'host-c'][(n - 1) // 10 + 1] end as worker_id,
                   case when n is null then started_at else timestamp '2024-01-01 06:00:00' end as started_at
            from ledger left join (
              select id, row_number() over (order by id) as n from ledger
              where status = 'pending' and retry_count < 3 qualify n <= 30) using (id)"""),
        "claim_everything": _with(LEDGER, """
            select id, concat('worker-', (row_number() over (order by id) - 1) // 10) as worker from ledger
            where status = 'pending' and retry_count < 3"""),
        "reset_stale": _with(
            LEDGER,
            f"""
            select id, {moved.format("'pending'", "status")} as status, {moved.format("null", "worker_id")} as worker_id,
                   {moved.format("null", "started_at")} as started_at,
                   {moved.format("retry_count + 1", "retry_count")} as retry_count
            from (select *, coalesce(status = 'processing' and started_at < timestamp '2024-01-01 05:00:00', false)
                  as stale from ledger)"""),
        "mark_complete": _with(OUTCOMES, f"""
            select id, case when {done} then 'complete' else status end as status, worker_id, started_at,
                   case when {done} then timestamp '2024-01-01 06:00:00' else completed_at end as completed_at,
                   case when {done} then o.output_path else l.output_path end as output_path,
                   case when {done} then o.page_count else l.page_count end as page_count
            from ledger l left join outcomes o using (id)"""),
        "mark_error": _with(OUTCOMES, f"""
            select id, case when {bad} then {status_bad} else status end as status,
                   case when {bad} then null else worker_id end as worker_id,
                   case when {bad} then null else started_at end as started_at,
                   case when {bad} then left(o.error_message, 4000) else l.error_message end as error_message,
                   case when {bad} then retry_count + 1 else retry_count end as retry_count
            from ledger l left join outcomes o using (id)"""),
        "isolate_errors": _with(OUTCOMES, f"""
            select id, case when {done} then 'complete' when {bad} then {status_bad} else status end as status,
                   case when {bad} then null else worker_id end as worker_id,
                   case when {bad} then null else started_at end as started_at,
                   case when {done} then timestamp '2024-01-01 06:00:00' else completed_at end as completed_at,
                   case when {bad} then left(o.error_message, 4000) else l.error_message end as error_message,
                   case when {bad} then retry_count + 1 else retry_count end as retry_count,
                   case when {done} then o.output_path else l.output_path end as output_path,
                   case when {done} then o.page_count else l.page_count end as page_count
            from ledger l left join outcomes o using (id)"""),
        "reset_failed": _with(LEDGER, """
            select id, case when status = 'failed' then 'pending' else status end as status,
                   case when status = 'failed' then 0 else retry_count end as retry_count,
                   case when status = 'failed' then null else error_message end as error_message from ledger"""),
        "image_results": _with(_and(LEDGER, RECOGNISED), """
            select l.id as image_id, l.file_path, status, page_number, confidence as confidence_score, ocr_engine
            from ledger l left join recognised r on r.image_id = l.id"""),
        "orphan_results": _with(_and(LEDGER + PURGED, RECOGNISED), """
            select image_id, page_number, ocr_engine from recognised
            where image_id not in (select id from remaining)"""),
        "cascade_delete": _with(_and(LEDGER + PURGED, RECOGNISED), """
            select image_id, page_number, ocr_engine from recognised
            where image_id in (select id from remaining)"""),
        "dup_pages": _with(RECOGNISED + POOR, """
            select image_id, page_number, count(*) as n from (
              select image_id, page_number from recognised union all
              select image_id, page_number from recognised where image_id in (select image_id from poor))
            group by all having count(*) > 1"""),
        "review_queue": _with(RECOGNISED, """
            select image_id, page_number, confidence as confidence_score, ocr_engine from recognised
            where confidence < 0.6::double order by 3, 1, 2"""),
        "append_results": _with(RECOGNISED + POOR, """
            select image_id, page_number, text as extracted_text,
                   case when image_id in (select image_id from poor) then 'easyocr' else ocr_engine end as ocr_engine
            from recognised"""),
        "snapshot_roundtrip": _with(LEDGER, """
            select id, file_path, case when status = 'failed' then 'pending' else status end as status,
                   case when status = 'failed' then 0 else retry_count end as retry_count from ledger"""),
        "run_rounds": _with(_and(ROUNDS, PLACED, TEXT_PAGES), """
            select q.id, case when run and bad then 'failed' when run then 'complete' when stale then 'pending'
                              else status end as status,
                   case when run and bad then null when run then 'job-1' when stale then null
                        else worker_id end as worker_id,
                   cast(case when run and bad then 3 else tries end as integer) as retry_count,
                   case when run and not bad then p.output_base end as output_path,
                   case when run and not bad then n.pages end as page_count,
                   (run and bad) or error_message is not null as has_error
            from queued q join placed p using (id)
            join (select image_id, cast(count(*) as integer) as pages from text_pages group by 1) n
              on n.image_id = q.id"""),
        "run_rounds_results": _with(_and(ROUNDS, TEXT_PAGES), f"""
            select image_id, page_number, text as extracted_text,
                   {CONFIDENCE.format(n="n", s="(s * 10)")} as confidence_score, 'plain' as ocr_engine
            from (select *, len(w) as n, coalesce(list_sum(list_transform(w, lambda t: least(length(t), 10))), 0)::bigint as s
                  from (select *, list_filter({ocr_words}, lambda t: t <> '') as w from text_pages))
            where image_id in (select id from queued where run and not bad)"""),
        "page_explode": _with(TEXT_PAGES, "select image_id, page_number, text from text_pages"),
        "page_metrics": _with(RECOGNISED, "select image_id, page_number, word_count, char_count from recognised"),
        "chat_metrics": f"""
            select conv_id as image_id, cast(turn + 1 as integer) as page_number,
                   cast(len(list_filter({ocr_words}, lambda w: w <> '')) as integer) as word_count,
                   cast(length(text) as integer) as char_count from conversations""",
        "text_strip": _with(TEXT_PAGES, """
            select image_id, page_number, regexp_replace(text, '^\\s+|\\s+$', '', 'g') as stripped from text_pages"""),
        "assemble_text": _with(TEXT_PAGES, f"""
            select image_id, {full_text} as full_text, cast(count(*) as integer) as page_count
            from text_pages group by 1"""),
        "assemble_chat": f"""
            select conv_id as image_id, {full_text.replace("page_number", "turn")} as full_text,
                   cast(count(*) as integer) as page_count
            from conversations group by 1""",
        "document_json": _with(RECOGNISED, """
            select image_id, cast(count(*) over (partition by image_id) as integer) as page_count,
                   page_number, text, confidence, word_count, char_count, processing_time_ms from recognised"""),
        "doc_time": _with(RECOGNISED, """
            select image_id, cast(count(*) as integer) as page_count,
                   cast(sum(processing_time_ms) as bigint) as total_processing_time_ms
            from recognised group by image_id"""),
        "document_index": doc_rows,
        "docs_roundtrip": _with(placed_pages, """
            select rel as relative_path, cast(sum(processing_time_ms) over (
                     partition by image_id) as bigint) as total_processing_time_ms, '2024-01-01T06:00:00+00:00' as processed_at,
                   page_number, text, confidence, word_count, char_count, processing_time_ms
            from recognised join placed on id = image_id"""),
        "sink_txt": _with(text_files, """
            select concat(name, '.txt') as relative_path,
                   octet_length(encode(body)) as bytes, octet_length(encode(body)) as bytes_on_disk from texts"""),
        "sink_json": _with(text_files, """
            select concat(name, '.json') as relative_path, cast(pages as integer) as page_count,
                   cast(pages as integer) as n_pages, sha256(body) as text_sha256, true as size_as_said from texts"""),
        "sink_paged": _with(text_files, """
            select concat(name, '.json') as relative_path, cast(pages as integer) as page_count,
                   cast(pages as integer) as n_pages, sha256(body) as text_sha256, true as size_as_said,
                   octet_length(encode(body)) as txt_bytes from texts"""),
        "ledger_changes": _with(LEDGER + """,
            counted as (
              select *, case id % 8 when 0 then 1 when 1 then 3 when 2 then 5 when 3 then 7 when 4 then 4 else 0 end as more,
                     case id % 8 when 0 then 'change 0' when 1 then 'change 1' when 2 then 'change 2'
                                 when 3 then 'change 3' when 4 then 'change 3' else error_message end as message
              from ledger)""", """
            select id, file_path, status, cast(retry_count + more as integer) as retry_count, message as error_message
            from counted union all
            select id + 1000000000::bigint * n, file_path, status, retry_count, error_message
            from ledger, (select unnest([1, 2, 3, 4]) as n) where id % 8 = 5"""),
        "retention": _with(RECOGNISED, """
            select image_id, page_number, ocr_engine, 'ledger/v=1 ledger/v=2 results/run-lost' as swept
            from recognised"""),
        "recognise_guarded": _with(TEXT_PAGES, f"""
            select image_id, page_number, case when not bad then text end as text,
                   case when not bad then {CONFIDENCE.format(n="n", s="(s * 10)")} end as confidence,
                   case when bad then 'engine ended with code 3' end as error
            from (select *, image_id in (select doc_id from labels where toxic = 1) as bad, len(w) as n,
                         coalesce(list_sum(list_transform(w, lambda t: least(length(t), 10))), 0)::bigint as s
                  from (select *, list_filter({ocr_words}, lambda t: t <> '') as w from text_pages))"""),
        "conf_percent": _with(TOKENS, f"""
            select p.image_id, p.page_number, regexp_replace(p.text, '^\\s+|\\s+$', '', 'g') as text,
                   coalesce({CONFIDENCE.format(n="t.n", s="t.s")}, 0.0) as confidence
            from text_pages p left join (
              select image_id, page_number, sum(conf) filter (conf >= 0) as s, count(*) filter (conf >= 0) as n
              from tokens group by all) t using (image_id, page_number)"""),
        "tokens_space": _join_tokens("' '", "text"),
        "lines_newline": _join_tokens("chr(10)", "(case when conf >= 0 then text end)"),
        "round4": f"""
            select doc_id, case when w > 0 then ((n_chars * 20000 + w) // (2 * w)) / 10000.0::double end
                     as chars_per_word
            from (select *, len(list_filter({ocr_words}, lambda t: t <> '')) as w from documents)""",
        "lang_split": """
            select doc_id, concat(lang, ',en') as all_languages, lang as first_language from documents""",
        "iso_time": """
            select event_id, concat(strftime(ts, '%Y-%m-%dT%H:%M:%S'),
                   case when microsecond(ts) % 1000000 <> 0 then strftime(ts, '.%f') else '' end, '+00:00') as iso
            from events""",
        "recognise_stub": _with(TEXT_PAGES, f"""
            select image_id, page_number, text, {CONFIDENCE.format(n="n", s="(s * 10)")} as confidence,
                   'plain' as ocr_engine, cast(null as varchar) as error
            from (select *, len(w) as n, coalesce(list_sum(list_transform(w, lambda t: least(length(t), 10))), 0)::bigint as s
                  from (select *, list_filter({ocr_words}, lambda t: t <> '') as w from text_pages))"""),
        "dpi_parse": _with(DPI_PAGES, "select id, x_dpi, y_dpi from parsed"),
        "dpi_plan": _with(DPI_PAGES, """
            select id, scale, resized, case when resized then cast(nw as integer) else width end as new_width,
                   case when resized then cast(nh as integer) else height end as new_height
            from (select *, scale <= 5 and abs(scale - 1) > 1e-9 and current < 200 and nw * nh <= 20000000 as resized
                  from (select *, greatest(1, cast(trunc(width * scale) as bigint)) as nw,
                               greatest(1, cast(trunc(height * scale) as bigint)) as nh
                        from (select *, 300.0::double / current as scale
                              from (select *, case when x_dpi between 10 and 1200 then x_dpi else 300.0::double end
                                      as current from parsed))))"""),
        "dpi_scale": _with(DPI_PAGES, """
            select id, case when resized then cast(nw as integer) else width end as new_width,
                   case when resized then cast(nh as integer) else height end as new_height
            from (select *, scale <= 5 and abs(scale - 1) >= 1e-9 and nw * nh <= 20000000 as resized
                  from (select *, greatest(1, cast(trunc(width * scale) as bigint)) as nw,
                               greatest(1, cast(trunc(height * scale) as bigint)) as nh
                        from (select *, 300.0::double / x_dpi as scale from parsed)))"""),
        "grid_luma": _with(GRID_LINES, "select image_id, page_number, y, x, v from colour_gray"),
        "grid_resample": _with(
            GRID_LINES + "," + PAGE_PLAN + "," + _resample("grid", "page_plan", "rs", ("v",)),
            "select image_id, page_number, y, x, v from rs_grid",
        ),
        "otsu_threshold": _with(
            GRID_LINES + "," + _otsu("grid", "o"),
            "select image_id, page_number, threshold from o_threshold",
        ),
        "otsu_binarise": _with(
            GRID_LINES + "," + _otsu("grid", "o"),
            """select image_id, page_number, y, x, case when v > threshold then 255 else 0 end as v
               from grid join o_threshold using (image_id, page_number)""",
        ),
        "skew_angle": _with(
            GRID_LINES + "," + _skew("grid", "k"),
            "select image_id, page_number, round(angle, 6) as angle from k_angle",
        ),
        "grid_rotate": _with(
            GRID_LINES + "," + TURNS + "," + _rotate("grid", "turns", "ro"),
            "select image_id, page_number, y, x, v from ro_grid",
        ),
        "sauvola": _with(
            GRID_LINES + "," + _sauvola("grid", "sv"),
            "select image_id, page_number, y, x, v from sv_grid",
        ),
        "page_prep_pixels": _with(
            PREP + "," + _rotate("gray", "turning", "ro") + "," + _sauvola("ro_grid", "sv"),
            "select image_id, page_number, y, x, v from sv_grid",
        ),
        "recognise_clean": _with(
            PREP + "," + _rotate("gray", "turning", "ro") + "," + _sauvola("ro_grid", "sv"), f"""
            select image_id, page_number, prepared, string_agg(t, ' ' order by band) as text,
                   {CONFIDENCE.format(n="count(*)", s="(cast(sum(least(length(t), 10)) as bigint) * 10)")} as confidence,
                   cast(null as varchar) as error
            from (select image_id, page_number, prepared, y // 16 as band,
                         cast(count(*) filter (v < 128) as varchar) as t
                  from (select *, true as prepared from sv_grid union all by name
                        select image_id, page_number, y, x, v, false as prepared from colour_gray)
                  group by all)
            group by image_id, page_number, prepared"""),
        "page_prep_flags": _with(PREP, """
            select p.image_id, p.page_number,
                   case when (p.image_id + p.page_number) % 3 = 0 then 150.0::double else 300.0::double end as x_dpi,
                   case when (p.image_id + p.page_number) % 3 = 0 then 150.0::double else 300.0::double end as y_dpi,
                   resized as was_upscaled, abs(angle) >= 0.5 as was_deskewed,
                   round(angle, 6) as skew_angle_degrees
            from page_plan p join sk_angle using (image_id, page_number)"""),
        "image_scan": _with(GRID_LINES, """
            select concat(image_id, '-', page_number) as name, max(x) + 1 as width, max(y) + 1 as height,
                   cast(sum(v) as bigint) as gray_sum, cast(sum(v * x) as bigint) as gray_x
            from colour_gray group by image_id, page_number"""),
        "list_tree": """
            select concat(folder, (['', '_', '.', 'a b#', 'q?%20', 'ü'])[doc_id % 6 + 1], doc_id,
                          (['.tif', '.TIFF', '.txt'])[doc_id % 7 % 3 + 1]) as relative_path,
                   case when doc_id % 11 = 0 then 0 else octet_length(encode(coalesce(text, ''))) end as file_size_bytes,
                   folder = '' as in_flat
            from (select *, (['', 'sub/', '.hidden/', '_x/two words/', '50% #1/'])[doc_id % 5 + 1] as folder from documents)
            where doc_id % 7 % 3 <> 2""",
        "decode_scan": """
            with scans as (
              select doc_id as image_id, doc_id in (select doc_id from labels where toxic = 1) as bad,
                     string_split(replace(coalesce(text, ''), chr(10), chr(12)), chr(12)) as l
              from documents)
            select image_id, cast(p as integer) as page_number, octet_length(encode(l[p])) as bytes, false as has_error
            from (select *, unnest(range(1, len(l) + 1)) as p from scans where not bad)
            union all select image_id, cast(0 as integer), cast(-1 as bigint), true from scans where bad""",
        "stream_discovery": _with(text_files, """
            select row_number() over (order by relative_path) as id, relative_path, file_size_bytes,
                   'pending' as status, cast(0 as integer) as retry_count
            from (select concat(name, '.txt') as relative_path,
                         octet_length(encode(body)) as file_size_bytes from texts)"""),
        "document_feed": """
            select user_id as image_id, min(ts) as ts from events where event_type = 'purchase' group by user_id""",
    }
