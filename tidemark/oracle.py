"""DuckDB SQL for the cross-check of every registered query (tables are pre-registered views).

The fixtures of ``tidemark.sources.fixtures`` are restated here as CTEs; each query's SQL states the expected
result from the relational ground truth (e.g. snapshot rows), not by re-running our text parsing.
"""

from __future__ import annotations

EV = """
ev as (
  select event_id, user_id as row_id,
         lpad(cast(user_id as varchar), cast(greatest(9, length(cast(user_id as varchar))) as integer), '0') as row_key,
         'mysql:' || event_type as "column",
         epoch_us(ts) as ts,
         cast(cast(round(value * 100) as bigint) as varchar) as value,
         false as is_null
  from events),
tomb as (
  select row_key, case when event_id % 500 = 0 then null else "column" end as "column", ts
  from ev where event_id % 50 = 0)"""

ORD = """
b as (select o_orderkey id, o_custkey custkey, o_orderstatus st,
             cast(round(o_totalprice * 100) as bigint) cents, o_orderpriority pr,
             cast(floor(o_orderkey / 100) as bigint) chunk,
             (cast(floor(o_orderkey / 100) as bigint) % 3) = 0 ch from orders),
s1 as (select id, custkey, st, cents, pr, chunk, ch from b where id % 10 <> 7),
s3 as (select id, custkey, case when ch and id % 130 = 0 then 'X' else st end st, cents, pr, chunk, ch from b
       where (id % 10 <> 7 and not (ch and id % 17 = 0)) or (ch and id % 20 = 7)),
snap as (
  select cast(100 as bigint) dump_ts, id, custkey, st, cents, pr, chunk from s1
  union all select 200, id, custkey, st, cents, pr, chunk from s1
  union all select 300, id, custkey, st, cents, pr, chunk from s3
  union all select 400, id, custkey, st, cents, pr, chunk from s3 where chunk < (select max(chunk) from b)
  union all select 500, id, custkey, st, case when ch and id % 260 = 1 then cents + 1 else cents end, pr, chunk
            from s3),
ordrows as (
  select *, '(' || id || ',' || custkey || ',' || chr(39) || st || chr(39) || ',' || cents || ',' || chr(39)
            || pr || chr(39) || ')' as r
  from snap),
ordchunks as (
  select 'shop' as namespace, 'orders' as tbl_name, dump_ts, chunk as seq,
         md5(string_agg(r, ',' order by id)) as md5, string_agg(r, ',' order by id) as payload,
         count(*) as n_rows
  from ordrows group by dump_ts, chunk),
ordcells as (
  select dump_ts, chunk, id as row_id,
         lpad(cast(id as varchar), cast(greatest(9, length(cast(id as varchar))) as integer), '0') row_key,
         c."column", c.value, false as is_null
  from snap, lateral (values ('mysql:custkey', cast(custkey as varchar)), ('mysql:st', st),
                             ('mysql:cents', cast(cents as varchar)), ('mysql:pr', pr)) c("column", value)),
manifest as (select namespace, tbl_name, dump_ts, seq, md5 from ordchunks),
didx as (select dump_ts, dense_rank() over (order by dump_ts) - 1 idx from (select distinct dump_ts from manifest)),
mset as (select distinct m.dump_ts, idx, md5 from manifest m join didx using (dump_ts)),
newc as (select a.dump_ts, a.md5 from mset a where not exists
           (select 1 from mset b where b.idx = a.idx - 1 and b.md5 = a.md5)),
cellmd5 as (select c.*, k.md5 from ordcells c join ordchunks k on k.dump_ts = c.dump_ts and k.seq = c.chunk)"""


def with_(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


ASOF_T = 1705276800000000  # 2024-01-15 00:00:00 UTC in µs: the read time of the EV as-of queries

SQL: dict[str, str] = {}

SQL["asof_scan"] = with_(EV) + f"""
select row_key, "column", max(row_id) row_id, max(ts) ts, arg_max(value, ts) value, arg_max(is_null, ts) is_null
from ev where ts <= {ASOF_T} group by row_key, "column"
"""

ORD_LATE = """
h15 as (
  select row_key, row_id, "column", cast(100 as bigint) ts, value, is_null, cast(100 as bigint) publish_id
  from ordcells where dump_ts = 100
  union all
  select c5.row_key, c5.row_id, c5."column", 500, c5.value, c5.is_null, 500
  from (select * from ordcells where dump_ts = 500) c5
  left join (select * from ordcells where dump_ts = 100) c1 using (row_key, "column")
  where c1.value is null or c1.value is distinct from c5.value),
inc as (select * from cellmd5 where dump_ts = 300
        and md5 not in (select md5 from ordchunks where dump_ts = 100)),
prevs as (select row_key, "column", arg_max(value, ts) value, max(ts) ts from h15 where ts <= 299
          group by row_key, "column"),
nexts as (select row_key, "column", arg_max(value, ts) value, arg_max(is_null, ts) is_null, max(ts) ts,
                 max(row_id) row_id from h15 where ts <= 500 group by row_key, "column"),
changed as (select i.* from inc i left join prevs p using (row_key, "column")
            where p.ts is null or p.value is distinct from i.value),
ident as (select i.row_key, i.row_id, i."column", i.value, i.is_null, i.md5, n.ts n_ts
          from inc i join nexts n using (row_key, "column") where n.value is not distinct from i.value),
ncount as (select row_key, count(*) n_cells from nexts group by row_key),
fullrows as (select row_key from (select row_key, count(*) n_same from ident group by row_key) x
             join ncount using (row_key) where n_same = n_cells),
redundant as (
  select distinct n_ts ts, md5, row_key, row_id, cast(null as varchar) "column" from ident
  where row_key in (select row_key from fullrows) and n_ts > 300
  union all
  select n_ts, md5, row_key, row_id, "column" from ident
  where row_key not in (select row_key from fullrows) and n_ts > 300),
removed as (select md5 from ordchunks where dump_ts = 100
            except select md5 from ordchunks where dump_ts = 300),
deletes as (select distinct cast(300 as bigint) ts, md5, row_key, row_id, cast(null as varchar) "column"
            from cellmd5 where dump_ts = 100 and md5 in (select md5 from removed)
            and row_key not in (select row_key from inc)),
restores as (select cast(500 as bigint) ts, c.row_key, c.row_id, c."column", n.value, n.is_null
             from changed c join nexts n using (row_key, "column")
             where n.ts < 300 and n.value is distinct from c.value),
writes as (select cast(300 as bigint) ts, row_key, row_id, "column", value, is_null from changed)"""

SQL["milestones"] = with_(ORD) + """
select 'shop' namespace, 'orders' tbl_name, dump_ts, count(*) n_new from newc group by dump_ts"""

SQL["removed_chunks"] = with_(ORD) + """
select 'shop' namespace, 'orders' tbl_name, a.dump_ts, b.md5 from mset a join mset b on b.idx = a.idx - 1
where not exists (select 1 from mset c where c.idx = a.idx and c.md5 = b.md5)
group by a.dump_ts, b.md5"""

SQL["milestone_bounds"] = with_(ORD) + """, ms as (select distinct dump_ts from newc)
select 'shop' namespace, 'orders' tbl_name, dump_ts,
       cast(coalesce(lag(dump_ts) over (order by dump_ts), 0) as bigint) prev_ts,
       cast(coalesce(lead(dump_ts) over (order by dump_ts), 1000) as bigint) next_ts from ms"""

SQL["manifest_changed"] = with_(ORD) + """, l as (
  select dump_ts, list(md5 order by seq) hl, count(*) n from manifest group by dump_ts)
select 'shop' namespace, 'orders' tbl_name, dump_ts, n n_chunks,
       coalesce(hl <> lag(hl) over (order by dump_ts), true) changed from l"""

SQL["chunks_since_published"] = with_(ORD) + """, d as (select distinct dump_ts from manifest),
pub as (select * from (values (100), (500)) t(p)),
base as (select d.dump_ts, (select max(p) from pub where p < d.dump_ts) baseline_ts from d)
select distinct 'shop' namespace, 'orders' tbl_name, m.dump_ts, cast(b.baseline_ts as bigint) baseline_ts, m.md5
from manifest m join base b using (dump_ts)
where not exists (select 1 from manifest o where o.dump_ts = b.baseline_ts and o.md5 = m.md5)"""

SQL["manifest_history"] = with_(ORD) + """
select namespace, tbl_name, dump_ts, row_number() over (partition by dump_ts order by seq) - 1 position, md5
from manifest"""

SQL["chunk_lookup"] = with_(ORD) + """
select dump_ts, seq, md5, payload from ordchunks"""

SQL["chunk_id_range"] = with_(ORD) + """
select distinct k.md5, min(c.id) first_id, max(c.id) last_id, count(*) n_rows
from ordchunks k join snap c on c.dump_ts = k.dump_ts and c.chunk = k.seq group by k.dump_ts, k.md5"""

SQL["publish_full"] = with_(ORD) + """
select row_key, row_id, "column", cast(100 as bigint) ts, value, is_null, cast(100 as bigint) publish_id
from ordcells where dump_ts = 100"""

SQL["publish_incremental"] = with_(ORD) + """, l as (
  select *, lag(value) over (partition by row_key, "column" order by dump_ts) pv,
            lag(dump_ts) over (partition by row_key, "column" order by dump_ts) pd
  from ordcells)
select row_key, row_id, "column", dump_ts ts, value, is_null, dump_ts publish_id from l
where pd is null or pv is distinct from value"""

SQL["publish_table"] = with_(ORD, ORD_LATE) + """
select * from h15
union all select row_key, row_id, "column", ts, value, is_null, 300 from writes
union all select row_key, row_id, "column", ts, value, is_null, 300 from restores"""

LINE = """
lsrc as (select cast(round(l_quantity) as bigint) l_quantity, l_orderkey, l_partkey, l_returnflag, l_linenumber from lineitem),
ldump as (select cast(100 as bigint) dump_ts, * from lsrc where l_orderkey % 7 <> 3
  union all select 200, * replace (l_quantity + case when l_orderkey % 11 = 0 and l_linenumber = 2 then 1 else 0 end as l_quantity)
            from lsrc where not (l_orderkey % 13 = 0 and l_linenumber = 1)),
lrank as (select *, row_number() over (partition by dump_ts, l_orderkey, l_linenumber
                                       order by l_partkey desc, l_quantity desc, l_returnflag desc) r,
                 count(*) over (partition by dump_ts, l_orderkey, l_linenumber) n from ldump)"""
SQL["published_composite_key"] = with_(LINE) + """
select dump_ts, l_quantity, l_orderkey, l_partkey, l_returnflag, l_linenumber from lrank where r = 1"""
SQL["duplicate_keys"] = with_(LINE) + """
select '1' || lpad(cast(l_orderkey as varchar), 20, '0') || '1' || lpad(cast(l_linenumber as varchar), 20, '0') row_key, n n_puts
from lrank where dump_ts = 100 and r = 1 and n > 1"""
SQL["published_string_key"] = """
select p_name as name, z || p_partkey as code from part, (values (''), ('0'), ('00'), ('x')) t(z)"""
SQL["typed_binary"] = """
select cast(c_custkey as bigint) id, upper(md5(c_name)) raw, upper(md5(c_name)) hex,
  case when c_custkey % 1024 < 256 then lpad(upper(to_hex(c_custkey % 1024)), 2, '0') else lpad(upper(to_hex(c_custkey % 1024)), 4, '0') end bits,
  c_name || ' é' || chr(39) || chr(92) note from customer"""

SQL["diff_changed_cells"] = with_(ORD, ORD_LATE) + """
select row_key, row_id, "column", value, is_null from changed"""

SQL["diff_identical_next"] = with_(ORD, ORD_LATE) + """
select row_key, row_id, "column", value, is_null, n_ts from ident"""

SQL["diff_redundant_future"] = with_(ORD, ORD_LATE) + """
select * from redundant"""

SQL["diff_deletes"] = with_(ORD, ORD_LATE) + """
select * from deletes"""

SQL["diff_restore"] = with_(ORD, ORD_LATE) + """
select * from restores
union all select cast(600 as bigint), i.row_key, i.row_id, i."column", p.value, p.is_null
from inc i join (select * from ordcells where dump_ts = 100) p using (row_key, "column") where p.value is distinct from i.value"""

SQL["snapshot_diff"] = with_(ORD, ORD_LATE) + """
select 'write' change_kind, ts, row_key, row_id, "column", value, is_null from writes
union all select 'delete', ts, row_key, row_id, "column", null, null from deletes
union all select 'redundant', ts, row_key, row_id, "column", null, null from redundant
union all select 'restore', ts, row_key, row_id, "column", value, is_null from restores"""

SQL["diff_delete_counts"] = with_(ORD, ORD_LATE) + """
select ts, count(*) n_deletes from deletes group by ts"""

SQL["diff_doomed_lists"] = with_(ORD, ORD_LATE) + """, doomed as (select * from deletes union all select * from redundant)
select ts, md5, count(*) n,
       array_to_string(list_sort(list(cast(row_id as varchar) || coalesce(':' || "column", ''))), ',') doomed
from doomed group by ts, md5"""


# ------------------------------------------------------------------ DUMP fixture in SQL
def _sqlstr(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _esc(x: str) -> str:
    for a, b in [("chr(92)", "chr(92) || chr(92)"), ("chr(39)", "chr(92) || chr(39)"), ("chr(10)", "chr(92) || 'n'"),
                 ("chr(13)", "chr(92) || 'r'"), ("chr(26)", "chr(92) || 'Z'")]:
        x = f"replace({x}, {a}, {b})"
    return x


def _render(col: str, kind: str) -> str:
    if kind == "int":
        v = f"cast({col} as varchar)"
    elif kind == "money":
        v = f"cast(cast({col} as decimal(15,2)) as varchar)"
    else:
        v = f"(chr(39) || {_esc(col)} || chr(39))"
    return f"coalesce({v}, 'NULL')"


def _dump_cte() -> str:
    from tidemark.sources import fixtures as FX
    rows = ", ".join(f"({o}, {_sqlstr(v)})" for o, v in FX.dump_text_lines())
    ctes = [f"txt as (select cast({FX.DUMP_ID} as bigint) dump_id, cast(o as bigint) ord, v as value "
            f"from (values {rows}) t(o, v))",
            "src_customer as (select * replace (case when c_custkey % 11 = 0 then null else c_mktsegment end "
            "as c_mktsegment) from customer)",
            "src_nation as (select * from nation)",
            "src_documents as (select * replace ("
            "case when doc_id % 5 = 0 then text || ' ' || chr(39) || 'q' || chr(92) || 'b ),(9,' || chr(39) || 'x' "
            "|| chr(92) || chr(92) || 'n' else text end as text, "
            "case when doc_id % 7 = 3 then 'NULL' when doc_id % 7 = 4 then null else source end as source) "
            "from documents)"]
    parts = ["select * from txt"]
    for ti, (table, key, cols, _k) in enumerate(FX.DUMP_TABLES, start=1):
        tup = " || ',' || ".join(_render(c, kind) for c, _d, kind in cols)
        ctes.append(
            f"tup_{table} as (select cast({key} as bigint) k, cast(floor({key} / {FX.DUMP_CHUNK}) as bigint) chunk, "
            f"'(' || {tup} || ')' t from src_{table})")
        ctes.append(
            f"ins_{table} as (select cast({FX.DUMP_ID} as bigint) dump_id, "
            f"cast({ti * FX.TABLE_BLOCK + FX.INSERT_OFFSET} + chunk as bigint) ord, "
            f"'INSERT INTO `{table}` VALUES ' || string_agg(t, ',' order by k) || ';' as value "
            f"from tup_{table} group by chunk)")
        parts.append(f"select * from ins_{table}")
    ctes.append("dumpsrc as (" + " union all ".join(parts) + ")")
    ctes.append("dlines as (select dump_id, row_number() over (partition by dump_id order by ord) - 1 line_no, "
                "value, ord from dumpsrc)")
    ctes.append(r"""dkind as (select *, case
      when substr(value, 1, 13) = '/*!50001 VIEW' then 'view'
      when regexp_replace(substr(value, 1, 6), '^\s+|\s+$', '', 'g') = 'INSERT' then 'insert'
      when regexp_replace(substr(value, 1, 6), '^\s+|\s+$', '', 'g') = 'CREATE' then 'create'
      when substr(regexp_replace(substr(value, 1, 6), '^\s+|\s+$', '', 'g'), 1, 2) in ('--', '/*')
           or regexp_replace(substr(value, 1, 6), '^\s+|\s+$', '', 'g') = '' then 'useless'
      else 'other' end as kind from dlines)""")
    ctes.append(r"""dstmt as (select *, case
      when kind = 'view' then regexp_extract(value, '^/\*!50001 VIEW\s+`?([^`\s]+)`?\s+AS\s', 1)
      when kind in ('insert', 'create') then
        trim(regexp_extract(value, '^\s*\S+\s+\S+\s+(`[^`]*`|[^\s(`]+)', 1), '`')
      else '' end as tbl_name from dkind)""")
    ctes.append(r"""dseg as (select *, max(case when kind <> 'other' then line_no end)
                    over (partition by dump_id order by line_no rows between unbounded preceding and current row) seg
                  from dstmt)""")
    ctes.append(r"""dcreate as (select s.dump_id, s.seg line_no, max(case when s.line_no = s.seg then s.tbl_name end) tbl_name,
        string_agg(regexp_replace(s.value, '^\s+|\s+$', '', 'g'), '' order by s.line_no) stmt
      from dseg s where s.seg in (select line_no from dstmt where kind = 'create') group by s.dump_id, s.seg)""")
    ctes.append(r"""dddl as (select dump_id, line_no, tbl_name, stmt,
        regexp_replace(substr(stmt, strpos(stmt, '('), length(stmt) - strpos(stmt, '(') + 1 - length(split_part(stmt, ';', -1))),
                       '[ */;]+$', '') payload from dcreate)""")
    return ",\n".join(ctes)


DUMP = _dump_cte()
DUMP_TS = 1358644800


def _dump_schema_rows() -> str:
    """Expected (table, pos, column, mysql_type, unsigned, precision, scale) from the DUMP layout metadata."""
    import re
    from tidemark.sources import fixtures as FX
    out = []
    for table, _k, cols, _keys in FX.DUMP_TABLES:
        for pos, (c, decl, _kind) in enumerate(cols):
            t = re.match(r"([A-Za-z]+)", decl).group(1).lower()
            m = re.match(r"[A-Za-z]+\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", decl)
            p = m.group(1) if m else "null"
            sc = m.group(2) if (m and m.group(2)) else "null"
            out.append(f"('{table}', {pos}, '{c}', '{t}', {'true' if 'unsigned' in decl else 'false'}, "
                       f"cast({p} as integer), cast({sc} as integer))")
    return ("dschema as (select * from (values " + ", ".join(out) +
            ") t(tbl_name, pos, \"column\", mysql_type, unsigned, \"precision\", scale))")


DSCHEMA = _dump_schema_rows()
TYPEMAP = """case mysql_type when 'tinyint' then 'tinyint' when 'smallint' then 'smallint' when 'int' then 'int'
  when 'mediumint' then 'int' when 'bigint' then 'bigint' when 'float' then 'float' when 'double' then 'double'
  when 'longblob' then 'binary' else 'string' end"""
KNOWN = ("'tinyint','smallint','int','mediumint','bigint','float','double','set','tinytext','varchar','mediumtext',"
         "'text','enum','time','date','datetime','timestamp','decimal','longblob'")
DUMPROWS = """
dcells as (
  select 'customer' tbl_name, c_custkey k, c.* from src_customer, lateral (values
    ('mysql:c_name', c_name), ('mysql:c_nationkey', cast(c_nationkey as varchar)),
    ('mysql:c_acctbal', cast(cast(c_acctbal as decimal(15,2)) as varchar)), ('mysql:c_mktsegment', c_mktsegment))
    c("column", value)
  union all
  select 'nation', n_nationkey, c.* from src_nation, lateral (values
    ('mysql:n_name', n_name), ('mysql:n_regionkey', cast(n_regionkey as varchar))) c("column", value)
  union all
  select 'documents', doc_id, c.* from src_documents, lateral (values
    ('mysql:text', text), ('mysql:lang', lang), ('mysql:source', source), ('mysql:n_chars', cast(n_chars as varchar)))
    c("column", value))"""

SQL["scan_dump_lines"] = with_(DUMP) + "select dump_id, line_no, value from dlines"
SQL["classify_lines"] = with_(DUMP) + "select dump_id, line_no, kind from dkind"
SQL["statement_table_name"] = with_(DUMP) + "select line_no, kind, tbl_name from dstmt where kind in ('insert','create','view')"
SQL["insert_payload"] = with_(DUMP) + r"""
select line_no, tbl_name, md5(p) payload_md5, cast(length(p) as bigint) payload_len from (
  select line_no, tbl_name, substr(value, strpos(value, '('), length(value) - strpos(value, '(')) p
  from dstmt where kind = 'insert')"""
SQL["scalar_md5"] = with_(DUMP) + "select line_no, md5(value || chr(10)) md5 from dlines"
SQL["assemble_create"] = with_(DUMP) + "select dump_id, line_no, tbl_name, stmt from dcreate"
SQL["create_payload"] = with_(DUMP) + "select tbl_name, payload from dddl"
SQL["view_body"] = with_(DUMP) + r"""
select tbl_name as name, regexp_replace(regexp_extract(value, '^/\*!50001 VIEW\s+`?[^`\s]+`?\s+AS\s+(.*)$', 1),
  '[ */;]+$', '') body from dstmt where kind = 'view'"""
SQL["dump_timestamp"] = with_(DUMP) + f"""
select dump_id, arg_max(value, line_no) last_line, cast({DUMP_TS} as bigint) dump_ts from dlines group by dump_id"""
SQL["dump_rowcount"] = with_(DUMP) + "select dump_id, count(*) rowcount from dlines group by dump_id"
SQL["dump_fingerprint"] = with_(DUMP) + """, b as (
  select dump_id, line_no // 65536 b, md5(string_agg(md5(value || chr(10)), '' order by line_no)) h
  from dlines group by dump_id, line_no // 65536)
select dump_id, md5(string_agg(h, '' order by b)) line_md5 from b group by dump_id"""
SQL["skip_tables"] = with_(DUMP) + """
select distinct kind, tbl_name from dstmt where (kind in ('create', 'insert') and tbl_name <> 'nation') or kind = 'view'"""
SQL["parse_ddl"] = with_(DSCHEMA) + 'select tbl_name, pos, "column", mysql_type, unsigned, "precision", scale from dschema'
SQL["type_mapping"] = with_(DSCHEMA) + f"""
select tbl_name, "column", mysql_type, {TYPEMAP} sql_type, mysql_type in ({KNOWN}) mapped,
  case when mysql_type = 'decimal' then 'decimal(' || coalesce("precision", 10) || ',' || coalesce(scale, 0) || ')'
       when mysql_type = 'date' then 'date' when mysql_type in ('datetime', 'timestamp') then 'timestamp'
       when unsigned and mysql_type = 'tinyint' then 'smallint' when unsigned and mysql_type = 'smallint' then 'int'
       when unsigned and mysql_type in ('int', 'mediumint') then 'bigint'
       when unsigned and mysql_type = 'bigint' then 'decimal(20,0)'
       else {TYPEMAP} end native_type
from dschema"""
SQL["qualified_columns"] = with_(DSCHEMA) + """select tbl_name, pos, 'mysql:' || "column" qualified from dschema"""
SQL["parse_tuples"] = with_(DUMP) + """
select tbl_name, cast(row_number() over (partition by tbl_name, chunk order by k) - 1 as integer) tuple_pos, arity, k
from (
  select 'customer' tbl_name, k, chunk, 5 arity from tup_customer union all
  select 'nation', k, chunk, 3 from tup_nation union all
  select 'documents', k, chunk, 5 from tup_documents)"""
SQL["rows_to_cells"] = with_(DUMP, DUMPROWS) + """
select tbl_name, lpad(cast(k as varchar), cast(greatest(9, length(cast(k as varchar))) as integer), '0') row_key,
  cast(k as bigint) row_id, "column", value, value is null is_null from dcells"""
SQL["unescape_values"] = with_(DUMP) + "select doc_id, text from src_documents"
SQL["typed_read"] = with_(DUMP) + """
select cast(c_custkey as bigint) c_custkey, c_name, c_nationkey, cast(c_acctbal as decimal(15,2)) c_acctbal,
  c_mktsegment from src_customer"""
SQL["stage_manifest"] = with_(DUMP) + f"""
select 'shopdump' namespace, cast({DUMP_TS} as bigint) dump_ts, tbl_name, line_no seq, md5(value || chr(10)) md5
from dstmt where kind = 'insert'"""
SQL["stage_dump"] = with_(DUMP) + f""", b as (
  select dump_id, line_no // 65536 b, md5(string_agg(md5(value || chr(10)), '' order by line_no)) h
  from dlines group by dump_id, line_no // 65536),
fp as (select dump_id, md5(string_agg(h, '' order by b)) md5 from b group by dump_id)
select 'shopdump' namespace, cast({DUMP_TS} as bigint) dump_ts, 'staged' status,
  (select count(*) from dlines) rowcount, md5 from fp"""
SQL["ddl_lookup"] = with_(DUMP) + f"""
select 'shopdump' namespace, cast({DUMP_TS} as bigint) dump_ts, tbl_name name, payload stmt from dddl"""
SQL["view_lookup"] = with_(DUMP) + f"""
select 'shopdump' namespace, cast({DUMP_TS} as bigint) dump_ts, tbl_name name,
  regexp_replace(regexp_extract(value, '^/\\*!50001 VIEW\\s+`?[^`\\s]+`?\\s+AS\\s+(.*)$', 1), '[ */;]+$', '') stmt
from dstmt where kind = 'view'"""
SQL["manifest_of_dump"] = with_(DUMP) + """
select d.tbl_name, row_number() over (partition by d.tbl_name order by s.line_no) - 1 position,
  md5(s.value || chr(10)) md5, false missing
from dddl d join dstmt s on s.kind = 'insert' and s.tbl_name = d.tbl_name"""
SQL["stage_chunks_dedup"] = with_(ORD) + """
select distinct namespace, tbl_name, md5, payload from ordchunks where dump_ts >= 300
and md5 not in (select md5 from ordchunks where dump_ts <= 200)"""

LATEST = """select row_key, "column", max(row_id) row_id, max(ts) ts, arg_max(value, ts) value, arg_max(is_null, ts) is_null"""
SQL["asof_range_scan"] = with_(EV) + f""", r as (select min(row_id) lo, max(row_id) hi from ev)
{LATEST} from ev, r where ts <= {ASOF_T}
  and row_id between cast(floor(lo + (hi - lo) / 4) as bigint) and cast(floor(hi - (hi - lo) / 4) as bigint)
group by row_key, "column" """
SQL["row_latest"] = with_(EV) + f"""{LATEST} from ev group by row_key, "column" """
SQL["row_asof"] = with_(EV) + f""", b as (select row_key, cast((min(ts) + max(ts)) / 2 as bigint) bound
  from ev group by row_key)
{LATEST} from ev join b using (row_key) where ts <= bound group by row_key, "column" """
SQL["cell_versions"] = with_(EV) + """
select * from (select row_key, "column", ts, value,
  cast(row_number() over (partition by row_key, "column" order by ts desc) as integer) version from ev)
where version <= 3"""
SQL["cap_versions"] = with_(EV) + """
select row_key, "column", ts, value from (select *, row_number() over (partition by row_key, "column" order by ts desc) v
  from ev) where v <= 999"""
MASKED = """masked as (select e.* from ev e
  where not exists (select 1 from tomb t where t.row_key = e.row_key and t."column" = e."column" and t.ts >= e.ts)
    and not exists (select 1 from tomb t where t.row_key = e.row_key and t."column" is null and t.ts >= e.ts))"""
SQL["apply_tombstones"] = with_(EV, MASKED) + 'select row_key, "column", ts, value from masked'
SQL["tombstone_masked_asof"] = with_(EV, MASKED) + """
select row_key, "column", max(ts) ts, arg_max(value, ts) value from masked group by row_key, "column" """
SQL["tombstone_asof_corrected"] = with_(EV) + f""", t as (select * from tomb where ts <= {ASOF_T}),
m as (select e.* from ev e where e.ts <= {ASOF_T}
  and not exists (select 1 from t where t.row_key = e.row_key and t."column" = e."column" and t.ts >= e.ts)
  and not exists (select 1 from t where t.row_key = e.row_key and t."column" is null and t.ts >= e.ts))
select row_key, "column", max(ts) ts, arg_max(value, ts) value from m group by row_key, "column" """
SQL["state_pivot"] = with_(EV) + f""", s as ({LATEST} from ev where ts <= {ASOF_T} group by row_key, "column")
select row_key, max(row_id) row_id,
""" + ",\n".join(f"""  max(case when "column" = 'mysql:{t}' then value end) as {t}"""
                 for t in ["click", "error", "purchase", "signup", "view"]) + """
from s group by row_key"""
PAD = "lpad(cast({x} as varchar), cast(greatest(9, length(cast({x} as varchar))) as integer), '0')"
SQL["padded_key_order"] = f"""
select {PAD.format(x='a')} row_key, a row_id, row_number() over (order by a) - 1 place
from (select distinct o_orderkey a from orders union all select distinct o_orderkey * 100000 + 1 from orders)"""
SQL["restage_dump"] = with_(ORD) + """
select 'hash' kind, cast(100 as bigint) dump_ts, seq, md5 "value" from ordchunks where dump_ts = 300
union all select 'hash', 500, seq, md5 from ordchunks where dump_ts = 500
union all select 'view', 500, null, 'v'
union all select distinct 'chunk', null::bigint, null::bigint, md5 from ordchunks where dump_ts in (100, 300, 500)"""
SQL["asof_base_read"] = with_(ORD) + """
select dump_ts, id, custkey, st, cents, pr from snap where dump_ts in (100, 300, 400, 500)"""
SQL["stored_range_scan"] = with_(ORD) + """, r as (select min(o_orderkey) lo, max(o_orderkey) hi from orders)
select row_key, row_id, "column", value, is_null from ordcells, r where dump_ts = 400
  and row_id between cast(floor(lo + (hi - lo) / 4) as bigint) and cast(floor(hi - (hi - lo) / 4) as bigint)"""
SQL["drop_table"] = with_(ORD) + """
select 'history' kind, 'orders_copy' tbl_name, count(*) n from ordcells where dump_ts = 100
union all select 'log', 'orders_copy', 111"""
SQL["single_put"] = with_(ORD) + """
select cast(149 as bigint) "at", id, st from snap where dump_ts = 100
union all select 150, id, case when id % 10 = 0 then 'P' else st end from snap where dump_ts = 100"""
SQL["chunk_point_lookup"] = with_(ORD) + """
select md5, seq, payload from ordchunks where dump_ts = 500 and md5 not in (select md5 from ordchunks where dump_ts = 400)"""
SQL["scalar_zero_pad"] = f"""
select o_orderkey, {PAD.format(x='o_orderkey')} k9, {PAD.format(x='o_orderkey * 1000000')} k_wide from orders"""
SQL["scalar_unpad"] = f"""
select c_custkey, cast(try_cast({PAD.format(x='c_custkey')} as bigint) as varchar) unpadded,
  cast(try_cast(c_name as bigint) as varchar) name_key from customer"""
SQL["scalar_dump_time"] = """
select event_id, cast(epoch(date_trunc('second', ts)) as bigint) dump_ts,
  cast(epoch(date_trunc('day', ts)) as bigint) forced_ts from events"""
SQL["scalar_epoch_iso"] = """
select event_id, cast(floor(epoch_us(ts) / 1000000) as bigint) epoch,
  strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') iso from events"""

ALLDDL = """alld as (select 'shop' namespace, dump_ts, 'orders' name from (select distinct dump_ts from manifest)
  union all select 'shopdump', """ + str(1358644800) + """, tbl_name from dddl)"""
SQL["list_tables"] = with_(ORD, DUMP, ALLDDL) + "select distinct namespace, cast(dump_ts as bigint) dump_ts, name from alld"
SQL["list_views"] = with_(DUMP) + f"select 'shopdump' namespace, cast({DUMP_TS} as bigint) dump_ts, tbl_name name from dstmt where kind = 'view'"
SQL["list_dumps"] = with_(ORD) + f""", d as (select distinct 'shop' namespace, dump_ts from manifest
  union all select 'shopdump', cast({DUMP_TS} as bigint))
select namespace, dump_ts, strftime(make_timestamp(dump_ts * 1000000), '%Y-%m-%d %H:%M:%S') iso from d"""
SQL["list_namespaces"] = "select * from (values ('shop'), ('shopdump')) t(namespace)"
SQL["table_list_file"] = with_(DUMP) + "select tbl_name from dstmt where kind = 'create'"
SQL["select_tables"] = with_(DUMP) + """
select tbl_name, 'include' rule from dstmt where kind = 'create' and tbl_name <> 'nation'
union all select tbl_name, 'exclude' from dstmt where kind = 'create' and tbl_name <> 'nation'"""
SQL["has_data"] = with_(ORD, DUMP, ALLDDL) + """
select distinct name tbl_name, true has_data from alld
union all select 'debt_' || c_nationkey || '_' || c_mktsegment, max(c_acctbal < -990) from customer group by 1"""
SQL["statement_text"] = with_(DUMP) + r"""
select line_no, md5(t) statement_md5, cast(length(t) as bigint) statement_len from (
  select line_no, case when strpos(s, ';') > 0 then substr(s, 1, length(s) - length(split_part(s, ';', -1))) else s end t from (
    select line_no, regexp_replace(value, '^\s+|\s+$', '', 'g') s from dstmt
    where kind in ('insert', 'create', 'view') or suffix(value, ';')))"""
SQL["staging_time"] = with_(ORD) + """
select dump_ts, count(*) rowcount, true timed, true rounded from ordchunks where dump_ts in (100, 500) group by dump_ts"""
SQL["manifest_wide_map"] = with_(DUMP, ORD) + f""", hl as (
  select 'shopdump' namespace, cast({DUMP_TS} as bigint) dump_ts, tbl_name, line_no seq, md5(value || chr(10)) md5 from dstmt where kind = 'insert'
  union all select namespace, dump_ts, tbl_name, seq, md5 from ordchunks),
hp as (select *, row_number() over (partition by namespace, dump_ts, tbl_name order by seq) - 1 p from hl),
fp as (
  select md5(string_agg(h, '' order by b)) md5 from (
    select line_no // 65536 b, md5(string_agg(md5(value || chr(10)), '' order by line_no)) h
    from dlines group by line_no // 65536))
select 'shopdump' namespace, cast({DUMP_TS} as bigint) dump_ts, 'tables' family, tbl_name "key", payload "value" from dddl
union all select 'shopdump', {DUMP_TS}, 'views', tbl_name,
  regexp_replace(regexp_extract(value, '^/\\*!50001 VIEW\\s+`?[^`\\s]+`?\\s+AS\\s+(.*)$', 1), '[ */;]+$', '')
  from dstmt where kind = 'view'
union all select namespace, dump_ts, 'hashes', tbl_name || ':' || (p // 1000), string_agg(md5, ',' order by p) from hp
  group by namespace, dump_ts, tbl_name, p // 1000
union all select 'shopdump', {DUMP_TS}, 'meta', 'status', 'staged'
union all select 'shopdump', {DUMP_TS}, 'meta', 'rowcount', cast((select count(*) from dlines) as varchar)
union all select 'shopdump', {DUMP_TS}, 'meta', 'md5', (select md5 from fp)"""
TYPED_ORD = """
select cast(id as bigint) id, arg_max(custkey, dump_ts) custkey, arg_max(st, dump_ts) st,
  arg_max(cents, dump_ts) cents, arg_max(pr, dump_ts) pr from snap where dump_ts <= {t} group by id"""
SQL["published_asof"] = with_(ORD) + TYPED_ORD.format(t=300)
SQL["published_table"] = with_(ORD) + TYPED_ORD.format(t=500)
SQL["apply_views"] = """
select cast(c_custkey as bigint) c_custkey, n_name from customer c join nation n on c.c_nationkey = n.n_nationkey"""
SQL["publish_namespace"] = with_(DUMP, DUMPROWS) + """
select tbl_name, 'published' status, count(*) n_cells from dcells where tbl_name <> 'nation' group by tbl_name"""
SQL["rebuild_history"] = SQL["publish_incremental"]
SQL["asof_prev_next"] = with_(ORD, ORD_LATE) + """, k as (select distinct row_key from inc),
p as (select p.row_key, p."column", p.ts p_ts, p.value p_value from prevs p join k using (row_key)),
n as (select n.row_key, n."column", n.ts n_ts, n.value n_value from nexts n join k using (row_key))
select coalesce(p.row_key, n.row_key) row_key, coalesce(p."column", n."column") "column", p_ts, p_value, n_ts, n_value
from p full join n on p.row_key = n.row_key and p."column" = n."column" """
SQL["diff_suppress"] = with_(ORD, ORD_LATE) + """
select f.row_key, max(i.row_id) row_id from fullrows f join inc i using (row_key) group by f.row_key"""
SQL["diff_stats"] = with_(ORD, ORD_LATE) + """, ch as (
  select md5, count(distinct row_key) n_changed_rows,
    array_to_string(list_slice(list_sort(list(distinct row_id)), 1, 3), ',') preview from changed group by md5),
rows_ as (select md5, count(distinct row_key) n_incoming,
    count(distinct case when row_key in (select row_key from prevs) then row_key end) n_prev,
    count(distinct case when row_key in (select row_key from nexts) then row_key end) n_next from inc group by md5)
select md5, n_incoming, n_prev, n_next, coalesce(n_changed_rows, 0) n_changed_rows, preview from rows_ left join ch using (md5)"""
SQL["chunk_range_join"] = with_(ORD) + """, nc as (select md5 from newc where dump_ts = 300),
r as (select md5, min(row_id) lo, max(row_id) hi from cellmd5 where dump_ts = 300 and md5 in (select md5 from nc)
      group by md5),
h as (select distinct row_key, row_id from ordcells where dump_ts = 100)
select r.md5, h.row_key, h.row_id from r join h on h.row_id between r.lo and r.hi"""

SQL["published_events"] = with_(EV) + f""", s as ({LATEST} from ev where ts <= {ASOF_T} group by row_key, "column")
select cast(max(row_id) as bigint) user_id,
""" + ",\n".join(f"""  cast(max(case when "column" = 'mysql:{t}' then value end) as bigint) as {t}"""
                 for t in ["click", "error", "purchase", "signup", "view"]) + """
from s group by row_key"""

SQL["published_asof_deletes"] = with_(ORD) + """
select dump_ts, row_id, "column", value from ordcells where dump_ts in (100, 300, 400, 500)"""

LITERAL_STEP = """
i{d} as (select * from cellmd5 where dump_ts = {d} and md5 in (select md5 from newc where dump_ts = {d})),
r{d} as (select md5, min(row_id) lo, max(row_id) hi from i{d} group by md5),
s{d} as (select row_key, max(row_id) row_id, "column", arg_max(value, ts) value from h{d} where ts <= {p}
         group by row_key, "column"),
p{d} as (select s.* from s{d} s where exists (select 1 from r{d} r where s.row_id between r.lo and r.hi)),
pic{d} as (select distinct r.md5 from r{d} r join p{d} q on q.row_id between r.lo and r.hi),
w{d} as (select i.row_key, i.row_id, i."column", cast({d} as bigint) ts, i.value, i.is_null,
                cast({d} as bigint) publish_id
         from i{d} i left join p{d} q on q.row_key = i.row_key and q."column" = i."column"
         where (q.row_key is null or q.value is distinct from i.value)
           and (i.row_key in (select row_key from p{d}) or i.md5 not in (select md5 from pic{d})))"""
SQL["publish_literal"] = with_(ORD, """
w100 as (select row_key, row_id, "column", cast(100 as bigint) ts, value, is_null, cast(100 as bigint) publish_id
         from ordcells where dump_ts = 100),
h300 as (select * from w100)""", LITERAL_STEP.format(d=300, p=100), """
h500 as (select * from w100 union all select * from w300)""", LITERAL_STEP.format(d=500, p=300)) + """
select * from w100 union all select * from w300 union all select * from w500"""

SQL["rebuild_history_deletes"] = with_(ORD) + """
select dump_ts, row_id, "column", value from ordcells"""

SQL["schema_only_table"] = """
select o_orderkey::bigint as id, o_custkey::bigint as custkey, o_orderstatus::varchar as st,
       round(o_totalprice * 100)::bigint as cents, o_orderpriority::varchar as pr from orders where false"""
