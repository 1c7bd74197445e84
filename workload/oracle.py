"""Equivalent SQL for every query, over the generic test tables."""

from __future__ import annotations

# Input views, as given in FIXTURES.md, each a common table expression.
VIEWS = '''
pool as (
  select c_name as name, (c_custkey//10)%10 as col, (c_custkey//10)//10 as "row",
         concat_ws('_', c_name, (c_custkey//10)%10, (c_custkey//10)//10) as name_col_row
  from customer where c_custkey % 10 = 0),
qs as (
  select name, k%10 as col, k//10 as "row", concat_ws('_', name, k%10, k//10) as name_col_row
  from (select 'Customer#'||lpad(cast(s_suppkey*20 as varchar),9,'0') as name, s_suppkey*2 as k
        from supplier)),
incoming_all as (
  select o_orderkey, c_name as name, cast(o_orderkey%5 as int) as run,
         cast((o_orderkey//5)%5 as int) as iteration, o_orderstatus <> 'P' as processed,
         case when (o_custkey//10)%4 = 3 then 'validate' else 'train' end as usage,
         case when o_orderpriority in ('1-URGENT','2-HIGH') then 'true'
              when o_orderpriority = '5-LOW' then null else 'false' end as label
  from orders join customer on o_custkey = c_custkey where o_custkey % 10 = 0),
incoming as (select * exclude (o_orderkey) from incoming_all where o_orderkey % 4 <> 3),
incoming_static as (select * exclude (o_orderkey) from incoming_all where o_orderkey % 4 = 3),
merged as (select * from incoming union all select * from incoming_static),
labelled as (select * from merged where run = 0 and label = 'true'),
test_sites as (select * from pool where name not in (select name from labelled)),
catalog as (
  select k%10 as col, k//10 as "row", season,
         season||'_'||((k%10)//5 + 2*((k//10)//3)) as scene_id,
         's3://img/'||season||'_'||((k%10)//5 + 2*((k//10)//3))||'.tif' as uri
  from (select c_custkey//10 as k from customer where c_custkey % 10 = 0)
  cross join (values ('GS'),('OS')) s(season)
  where not (season = 'OS' and k % 17 = 16)),
pairs as (
  select g.col, g."row", g.scene_id as gs, o.scene_id as os
  from catalog g join catalog o on g.col = o.col and g."row" = o."row"
  where g.season = 'GS' and o.season = 'OS'),
grid as (
  select o_orderkey as k, ((o_orderkey//100)%10)*10 + o_orderkey%10 as gx,
         ((o_orderkey//100)//10)*10 + (o_orderkey%100)//10 as gy, o_orderstatus, o_orderpriority
  from orders),
px as (
  select g.gx, g.gy, s.season, l.b1, l.b2, l.b3, l.b4
  from grid g cross join (values ('GS','O'),('OS','F')) s(season, st)
  left join (select l_orderkey, l_linestatus,
                    cast(sum(cast(l_quantity as bigint)) as bigint) as b1,
                    cast(sum(cast(round(l_extendedprice) as bigint)) as bigint) as b2,
                    cast(sum(cast(round(l_discount*100) as bigint)) as bigint) as b3,
                    cast(sum(cast(round(l_tax*100) as bigint)) as bigint) as b4
             from lineitem group by 1, 2) l
    on l.l_orderkey = g.k and l.l_linestatus = s.st),
spx as materialized (
  select p.gx, p.gy, p.gx//10 as col, p.gy//10 as "row", p.season, c.scene_id, b1, b2, b3, b4
  from px p join catalog c on c.season = p.season and c.col = p.gx//10 and c."row" = p.gy//10),
mask as (
  select gx, gy, case when o_orderstatus = 'F' then 1
                      when o_orderpriority = '5-LOW' and k % 7 = 0 then null else 0 end as mask
  from grid),
scored as (
  select gx, gy, gx//10 as col, gy//10 as "row", cast(gx%10 as int) as column_index,
         cast(gy%10 as int) as row_index, cast((k*7919 + 13) % 1001 as int) as s from grid),
certainty as (
  select col, "row", avg((0.5 - s/1000.0::double)*(0.5 - s/1000.0::double)) as certainty
  from scored semi join test_sites using (col, "row") group by 1, 2),
worst as (
  select * from (select *, row_number() over (order by certainty, col + 13800*"row") as rn,
                        count(*) over () as n from certainty)
  where rn <= round_even(0.05*n, 0)),
eval_pairs as (
  select quality as label, toxic as prediction, n_chars as score
  from labels join documents using (doc_id)),
vec_tile as (select vec_id as cell, embedding as cells, label from embeddings)
'''


def _rate_columns(counts: str) -> str:
    """Metrics from a table with tn, fp, fn, tp."""
    return f'''
  select *, tp/nullif(tp+fn,0)::double + tn/nullif(tn+fp,0)::double - 1 as tss,
         (tp+tn)/nullif(tn+fp+fn+tp,0)::double as accuracy,
         tp/nullif(tp+fp,0)::double as "precision", tp/nullif(tp+fn,0)::double as recall,
         fp/nullif(fp+tn,0)::double as fpr, tp/nullif(tp+fn,0)::double as tpr
  from {counts}'''


_CONFUSION = '''
  select count(*) filter (label = 0 and prediction = 0) as tn,
         count(*) filter (label = 0 and prediction = 1) as fp,
         count(*) filter (label = 1 and prediction = 0) as fn,
         count(*) filter (label = 1 and prediction = 1) as tp
  from eval_pairs'''

_RATES = ", ".join(
    f'round({c}, 9) as "{c}"' for c in ("tss", "accuracy", "precision", "recall", "fpr", "tpr")
)

# All pairs of a positive and a negative row, by distinct score.
_AUC = '''
  select sum(a.p * b.n * case when a.score > b.score then 1.0 when a.score = b.score then 0.5 else 0 end)
         / (sum(a.p * b.n)) as auc
  from (select score, count(*) filter (label = 1) as p from eval_pairs group by 1) a,
       (select score, count(*) filter (label = 0) as n from eval_pairs group by 1) b'''

_HISTORY = f'''
history_counts as (
  select run, iteration + 1 as iteration,
         count(*) filter (coalesce(label,'false') <> 'true' and not processed) as tn,
         count(*) filter (coalesce(label,'false') <> 'true' and processed) as fp,
         count(*) filter (label = 'true' and not processed) as fn,
         count(*) filter (label = 'true' and processed) as tp
  from incoming_all group by 1, 2),
history as (
  select cast(run as int) as run, cast(iteration as int) as iteration, {_RATES},
         round(tpr - fpr, 9) as auc, 'aoi' || run as aoi,
         '2020-01-0' || iteration || ' 00:00:00.000000' as iteration_time
  from ({_rate_columns("history_counts")}))'''


def _band_list(expression: str, out: str) -> str:
    return ", ".join(f"{expression.format(b=b)} as {out}{b}" for b in (1, 2, 3, 4))


def _focal(kind: str, radius: int) -> str:
    """Brute force: visit every neighbour inside the window and the same scene."""
    value = {
        "avg": "sum(n.b{b})::double / nullif(count(n.b{b}), 0)",
        "std": "sqrt(cast(count(n.b{b}) * sum(n.b{b}*n.b{b}) - sum(n.b{b})*sum(n.b{b}) as double))"
        " / nullif(count(n.b{b}), 0)",
    }[kind]
    return f'''
  select t.season, t.scene_id, t.gx, t.gy, {_band_list(value, kind + "_")}
  from (select season, scene_id, gx, gy from spx) t
  cross join range(-{radius}, {radius + 1}) dx(i) cross join range(-{radius}, {radius + 1}) dy(j)
  join spx n on n.season = t.season and n.scene_id = t.scene_id and n.gx = t.gx + i and n.gy = t.gy + j
  group by all'''


_FEATURES = f'''
focal_avg as materialized ({_focal("avg", 5)}),
focal_std as materialized ({_focal("std", 2)}),
feature as materialized (
  select p.*, {", ".join(f"avg_{b}, std_{b}" for b in (1, 2, 3, 4))}
  from spx p join focal_avg using (season, scene_id, gx, gy)
             join focal_std using (season, scene_id, gx, gy))'''

_KEYS = 'col, "row", cast(gx%10 as int) as column_index, cast(gy%10 as int) as row_index'


def _feature_columns(alias: str, season: str) -> str:
    return ", ".join(
        f'{alias}.b{b}::double as "{season}_raw_{b}", round({alias}.avg_{b}, 9) as "{season}_avg_{b}", '
        f'round({alias}.std_{b}, 9) as "{season}_std_{b}"'
        for b in (1, 2, 3, 4)
    )


_COMPLETE = " and ".join(
    f'"{s}_{kind}_{b}" is not null' for s in ("GS", "OS") for kind in ("raw", "avg", "std") for b in (1, 2, 3, 4)
)

_JOINED = f'''
joined as (
  select g.gx, g.gy, g.col, g."row", {_feature_columns("g", "GS")}, {_feature_columns("o", "OS")}
  from pairs p join feature g on g.col = p.col and g."row" = p."row" and g.scene_id = p.gs
               join feature o on o.scene_id = p.os and o.gx = g.gx and o.gy = g.gy)'''


def _hash(seed: str, *keys: str) -> str:
    text = "||'_'||".join([f"'{seed}'", *keys])
    return f"(cast('0x'||substr(md5({text}),1,8) as bigint) / 4294967296.0::double)"


def _poisson_cdf(rates: str) -> str:
    """Distribution function at 0..33 for each (c, rate) row."""
    return f'''
  select c, i.range as i,
         sum(exp(-rate) * pow(rate, j.range) / cast(factorial(cast(j.range as int)) as double)) as cdf
  from {rates} r cross join range(0, 34) i join range(0, 34) j on j.range <= i.range group by 1, 2'''


def _resample(method: str, fx: str, fy: str, targets: str = "spx") -> str:
    positions = f'''
  select season, scene_id, gx, gy, {fx} as fx, {fy} as fy from {targets}'''
    if method == "nearest":
        return f'''
  select t.season, t.scene_id, t.gx, t.gy, {_band_list("n.b{b}::double", "b")}
  from (select *, cast(floor(fx + 0.5) as bigint) as sx, cast(floor(fy + 0.5) as bigint) as sy from ({positions})) t
  left join spx n on n.season = t.season and n.scene_id = t.scene_id and n.gx = t.sx and n.gy = t.sy'''
    value = "round(sum(w * n.b{b}) / sum(w) filter (n.b{b} is not null), 9)"
    return f'''
  select t.season, t.scene_id, t.gx, t.gy, {_band_list(value, "b")}
  from (select *, (1 - abs(fx - (floor(fx) + i.range))) * (1 - abs(fy - (floor(fy) + j.range))) as w,
               cast(floor(fx) + i.range as bigint) as sx, cast(floor(fy) + j.range as bigint) as sy
        from ({positions}) cross join range(0, 2) i cross join range(0, 2) j) t
  left join spx n on n.season = t.season and n.scene_id = t.scene_id and n.gx = t.sx and n.gy = t.sy
  group by t.season, t.scene_id, t.gx, t.gy'''


_SLOPE_TERMS = {
    b: (
        f"(max(n.b{b}) filter (i=1 and j=-1) + 2*max(n.b{b}) filter (i=1 and j=0) + max(n.b{b}) filter (i=1 and j=1)"
        f" - max(n.b{b}) filter (i=-1 and j=-1) - 2*max(n.b{b}) filter (i=-1 and j=0) - max(n.b{b}) filter (i=-1 and j=1))",
        f"(max(n.b{b}) filter (j=1 and i=-1) + 2*max(n.b{b}) filter (j=1 and i=0) + max(n.b{b}) filter (j=1 and i=1)"
        f" - max(n.b{b}) filter (j=-1 and i=-1) - 2*max(n.b{b}) filter (j=-1 and i=0) - max(n.b{b}) filter (j=-1 and i=1))",
    )
    for b in (1, 2, 3, 4)
}

_TEXT = "string_agg(coalesce(cast({v} as varchar), 'null'), ',' order by {o})"

_SCAN_SITES = 'select name, col, "row", name_col_row from {t}'

# name -> (extra common table expressions, final select)
QUERIES: dict[str, tuple[str, str]] = {
    # sources
    "scan_pool": ("", _SCAN_SITES.format(t="pool")),
    "scan_qs": ("", _SCAN_SITES.format(t="qs")),
    "scan_incoming": ("", "select * from incoming"),
    "incoming_merged": ("", "select * from merged"),
    "scan_catalog": ("", "select * from catalog"),
    "scan_pixels": ("", "select season, scene_id, gx, gy, b1, b2, b3, b4 from spx"),
    "scan_masks": (
        "",
        f'select gx//10 as col, gy//10 as "row", cast(gx%10 as int) as column_index, '
        f'cast(gy%10 as int) as row_index, mask from mask where (gx//10, gy//10) in (select (col, "row") from pool)',
    ),
    "readback_metrics": (_HISTORY, 'select * exclude (auc), auc as "AUC" from history'),
    # sinks
    "metrics_report": (
        f"counts as ({_CONFUSION}), roc as ({_AUC})",
        f'''select 0 as run, 5 as iteration, {_RATES}, (select round(auc, 9) from roc) as "AUC", 'aoi0' as aoi
            from ({_rate_columns("counts")})''',
    ),
    "report_times": ("", "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as iteration_time from events"),
    "parallel_reports": (
        ", ".join(
            f"counts{i} as (select * from ({_CONFUSION.replace('eval_pairs', f'(select * from eval_pairs where score % 2 = {i})')}))"
            for i in (0, 1)
        ),
        " union all ".join(
            f"""select {_RATES}, 0 as run, {iteration} as iteration, '{writer}' as writer, {clash} as writers
                from ({_rate_columns(f"counts{i}")})"""
            for writer, iteration, i, clash in (
                ("north", 5, 0, "'north,south'"), ("south", 5, 1, "'north,south'"), ("north", 6, 1, "null"))
        ),
    ),
    "outgoing_names": (
        f'''chosen as (select * from worst order by {_hash("7", "cast(col as varchar)", 'cast("row" as varchar)')},
                       col + 13800*"row" limit 10)''',
        '''select name, 0 as run, 5 as iteration, false as processed, 'train' as usage
           from pool semi join chosen using (col, "row")''',
    ),
    "load_metrics": (
        _HISTORY,
        '''select run, iteration, tss, accuracy, aoi, iteration_time, "precision", recall, fpr, tpr, auc
           from history where run = 0
            and iteration = (select max(iteration) + 1 from incoming where run = 0)''',
    ),
    "load_names": (
        "",
        '''select name, 0 as run, 5 as iteration, false as processed, 'train' as usage
           from pool semi join worst using (col, "row")
           where (select max(iteration) + 1 from incoming where run = 0) = 5''',
    ),
    "publish_tiles": (
        "",
        '''select 'aoi0' as aoi, 0 as run, 5 as iteration, gx//50 as col, gy//50 as "row",
                  'img_'||(gx//50)||'_'||(gy//50)||'_aoi0_0_5.tif' as path,
                  cast(gx%50 as int) as column_index, cast(gy%50 as int) as row_index,
                  cast(trunc(s/1000.0::double*100) as tinyint) as value from scored''',
    ),
    # projections, predicates
    "labelled_incoming": ("", "select name, iteration, processed, usage, true as is_labelled from labelled"),
    "nodata_filter": (
        "",
        '''select gx, gy, season, b1, b2, b3, b4, mask from px join mask using (gx, gy)
           where b1 is not null and b2 is not null and b3 is not null and b4 is not null and mask is not null''',
    ),
    "tile_paths": (
        "",
        '''select name, 'labels/'||name||'_'||col||'_'||"row"||'.tif' as mask_path,
                  's3://out/image_'||col||'_'||"row"||'_aoi0_0_5.tif' as image_path from pool''',
    ),
    # joins
    "season_pairs": (
        "",
        '''select g.col, g."row", g.uri as "GS", o.uri as "OS" from catalog g
           join catalog o on g.col = o.col and g."row" = o."row" where g.season = 'GS' and o.season = 'OS' ''',
    ),
    "test_names": ("", "select *, 'test' as usage from test_sites"),
    "all_names": ("", 'select p.name, col, "row", usage from pool p left join labelled i on i.name = p.name'),
    "site_uris": (
        "",
        '''select s.name, g.col, g."row", g.uri as "GS", o.uri as "OS" from catalog g
           join catalog o on g.col = o.col and g."row" = o."row" join test_sites s on s.col = g.col and s."row" = g."row"
           where g.season = 'GS' and o.season = 'OS' ''',
    ),
    "comprehensive_names": (
        "", 'select name, col, "row", name_col_row from pool full join qs using (name, col, "row", name_col_row)'
    ),
    "scene_expand": (
        f'''sampled as (select * from test_sites
              where {_hash("42", "cast(col as varchar)", 'cast("row" as varchar)')} < 0.1),
            scenes as (select distinct scene_id from catalog join sampled using (col, "row") where season = 'GS')''',
        '''select distinct s.name, s.col, s."row", s.name_col_row
           from scenes join catalog c using (scene_id)
           join (select * from pool union select * from qs) s on s.col = c.col and s."row" = c."row"
           where c.season = 'GS' ''',
    ),
    "restrict_scored": (
        "", 'select col, "row", column_index, row_index, s from scored semi join worst using (col, "row")'
    ),
    # aggregates
    "class_counts": (
        "",
        '''select mask, n, cast(sum(n) over () as bigint) as n_total
           from (select mask, count(*) as n from mask group by 1)''',
    ),
    "last_iteration": ("", "select max(iteration) as last_iteration from labelled"),
    "current_iteration": (
        "", "select cast(max(iteration) + 1 as int) as current_iteration from incoming where run = 0"
    ),
    "cell_certainty": ("", 'select col, "row", round(certainty, 9) as certainty from certainty'),
    "certainty_topk": (
        "", 'select col, "row", round(certainty, 9) as certainty, n as n_cells from worst'
    ),
    "confusion_matrix": ("", _CONFUSION),
    "binary_metrics": (
        f"counts as ({_CONFUSION})", f'select tn, fp, fn, tp, {_RATES} from ({_rate_columns("counts")})'
    ),
    "auc_roc": (f"roc as ({_AUC})", "select round(auc, 9) as auc from roc"),
    # geometry and map algebra
    "layout_geometry": (
        "cell as (select *, 69.0::double/13800 as w, 73.0::double/14600 as h from pool)",
        '''select name, round(w/10, 12) as pixel_width, round(h/10, 12) as pixel_height,
                  round(-17.541 + col*w, 9) as xmin, round(37.54 - ("row"+1)*h, 9) as ymin,
                  round(-17.541 + (col+1)*w, 9) as xmax, round(37.54 - "row"*h, 9) as ymax,
                  round(-17.541 + col*w - w/2, 9) as buffered_xmin, round(37.54 - ("row"+1)*h - h/2, 9) as buffered_ymin,
                  round(-17.541 + (col+1)*w + w/2, 9) as buffered_xmax, round(37.54 - "row"*h + h/2, 9) as buffered_ymax
           from cell''',
    ),
    "halo_window": (
        "",
        f'''select c.season, c.scene_id, c.col, c."row", cast(x.range as int) as column_index, cast(y.range as int) as row_index,
                   {_band_list("p.b{b}::double", "b")}
            from catalog c cross join range(-5, 15) x cross join range(-5, 15) y
            left join spx p on p.season = c.season and p.scene_id = c.scene_id
                           and p.gx = c.col*10 + x.range and p.gy = c."row"*10 + y.range''',
    ),
    "resample_bilinear": ("", _resample("bilinear", "gx + 0.25", "gy + 0.5")),
    "resample_nearest": ("", _resample("nearest", "gx + 0.25", "gy + 0.75")),
    "resample_scenes": (
        '''kinds as (
  select distinct scene_id, string_split(scene_id, '_')[2]::int as n from catalog),
grids as (
  select scene_id, case n % 3 when 0 then 1.0 when 1 then 0.5 else 1.25 end::double as scale,
         case n % 3 when 0 then 0.5 when 1 then 0.25 else 0.125 end::double as shift, n % 2 * 50 as x, n // 2 * 30 as y
  from kinds),
placed as (
  select season, scene_id, gx, gy, gx * scale + (x * (1 - scale) + shift) as px, gy * scale + (y * (1 - scale) + shift / 2) as py
  from spx join grids using (scene_id))''',
        _resample("bilinear", "px", "py", "placed"),
    ),
    "coarse_layer": (
        f'''{_FEATURES},
terrain as (select gx // 4 as x, gy // 4 as y, sum(b3) as v from px where season = 'GS' group by all),
near as (
  select *, (1 - abs(fx - (floor(fx) + i.range))) * (1 - abs(fy - (floor(fy) + j.range))) as w,
         cast(floor(fx) + i.range as bigint) as x, cast(floor(fy) + j.range as bigint) as y
  from (select gx, gy, gx * 0.25::double - 0.375 as fx, gy * 0.25::double - 0.375 as fy from spx where season = 'GS')
  cross join range(0, 2) i cross join range(0, 2) j),
layer as (
  select gx, gy, round(sum(w * v) / sum(w) filter (v is not null), 9) as terrain
  from near left join terrain using (x, y) group by gx, gy)''',
        f'select {_KEYS}, scene_id, {_feature_columns("f", "GS")}, terrain from feature f join layer using (gx, gy) where season = \'GS\'',
    ),
    "erode_tile": (
        "",
        '''select cell, cast(x.range - 2 as int) as column_index, cast(y.range - 2 as int) as row_index,
                  cells[y.range*8 + x.range + 1]::double as value
           from vec_tile cross join range(2, 6) x cross join range(2, 6) y''',
    ),
    "focal_mean": (
        f"focal_avg as ({_focal('avg', 5)})",
        f"select season, scene_id, gx, gy, {_band_list('round(avg_{b}, 9)', 'avg_')} from focal_avg",
    ),
    "focal_stddev": (
        f"focal_std as ({_focal('std', 2)})",
        f"select season, scene_id, gx, gy, {_band_list('round(std_{b}, 9)', 'std_')} from focal_std",
    ),
    "focal_slope": (
        "",
        f'''select t.season, t.scene_id, t.gx, t.gy, {", ".join(
            f"round(degrees(atan(sqrt(pow({dx}/240.0::double, 2) + pow({dy}/240.0::double, 2)))), 9) as slope_{b}"
            for b, (dx, dy) in _SLOPE_TERMS.items())}
            from (select season, scene_id, gx, gy from spx) t
            cross join range(-1, 2) dx(i) cross join range(-1, 2) dy(j)
            left join spx n on n.season = t.season and n.scene_id = t.scene_id and n.gx = t.gx + i and n.gy = t.gy + j
            group by t.season, t.scene_id, t.gx, t.gy''',
    ),
    "explode_tiles": (
        "",
        '''select cell, label, cast(i.range % 8 as int) as column_index, cast(i.range // 8 as int) as row_index,
                  cells[i.range + 1]::double as value from vec_tile cross join range(0, 64) i''',
    ),
    "assemble_tiles": (
        "",
        f'''select gx//10 as col, gy//10 as "row", season, cast(count(*) as int) as n_cells,
                   {", ".join(f"{_TEXT.format(v=f'b{b}', o='gy, gx')} as b{b}" for b in (1, 2, 3, 4))}
            from (select g.gx, g.gy, g.season, p.b1, p.b2, p.b3, p.b4 from (select distinct gx, gy, season from px) g
                  left join (select * from px where b1 is not null) p using (gx, gy, season)) group by all''',
    ),
    "scale_to_int8": (
        "",
        'select col, "row", column_index, row_index, '
        'cast(trunc(s/1000.0::double*100) as tinyint) as percent from scored',
    ),
    "retile_coarse": (
        "coarse as (select season, gx//50 as col, gy//50 as \"row\", gx%50 as x, gy%50 as y, b1, b2, b3, b4 from px),"
        "shell as (select * from (select distinct season, col, \"row\" from coarse) "
        "cross join range(0, 50) x(x) cross join range(0, 50) y(y))",
        f'''select season, col, "row", cast(count(*) as int) as n_cells,
                   {", ".join(f"{_TEXT.format(v=f'b{b}', o='y, x')} as b{b}" for b in (1, 2, 3, 4))}
            from shell left join coarse using (season, col, "row", x, y) group by all''',
    ),
    "overview_pyramid": (
        "",
        '''select cast(f as int) as factor, gx//f as gx, gy//f as gy, season, b1, b2, b3, b4
           from px cross join (values (2),(4),(8)) l(f) where gx % f = 0 and gy % f = 0''',
    ),
    "mosaic_window": (
        "",
        '''select name as window_id, col*10-4 as x0, "row"*10-4 as y0, cast(gx-(col*10-4) as int) as column_index,
                  cast(gy-("row"*10-4) as int) as row_index, b1, b2, b3, b4
           from pool join (select * from px where season = 'GS' and b1 is not null) p
           on gx >= col*10-4 and gx < col*10+13 and gy >= "row"*10-4 and gy < "row"*10+13''',
    ),
    "pyramid_window": (
        """wanted as (select name, f, (col*10)//f-3 as x0, ("row"*10)//f-3 as y0
                      from pool cross join (values (1),(2),(4)) l(f)),
           levels as (select f, gx//f as x, gy//f as y, b1, b2, b3, b4
                      from px cross join (values (1),(2),(4)) l(f)
                      where season = 'GS' and gx % f = 0 and gy % f = 0)""",
        '''select name as window_id, cast(w.f as int) as factor, x0, y0, cast(x-x0 as int) as column_index,
                  cast(y-y0 as int) as row_index, b1, b2, b3, b4,
                  cast(case when b1 is not null and b2 is not null and b3 is not null and b4 is not null
                       then 255 else 0 end as smallint) as mask
           from wanted w join levels l on w.f = l.f and x >= x0 and x < x0+13 and y >= y0 and y < y0+13''',
    ),
    "validity_mask": (
        "",
        '''select gx, gy, season, cast(case when b1 is not null and b2 is not null and b3 is not null
                  and b4 is not null then 255 else 0 end as smallint) as valid from px''',
    ),
    "feature_frame": (_FEATURES, f'select {_KEYS}, scene_id, {_feature_columns("f", "GS")} from feature f where season = \'GS\''),
    "join_features": (f"{_FEATURES}, {_JOINED}", f"select {_KEYS}, * exclude (gx, gy, col, \"row\") from joined"),
    "training_pixels": (
        f'''{_FEATURES}, {_JOINED},
        listed as (select col, "row", usage, count(*) as copies
                   from pool p join labelled i on i.name = p.name group by all)''',
        f'''select {_KEYS}, usage, copies, mask, * exclude (gx, gy, col, "row", usage, copies, mask)
            from joined join listed using (col, "row") join mask using (gx, gy)''',
    ),
    "test_pixels": (
        f"{_FEATURES}, {_JOINED}",
        f'select {_KEYS}, * exclude (gx, gy, col, "row") from joined semi join test_sites using (col, "row")',
    ),
    "sampled_pixels": (
        f'''{_FEATURES}, {_JOINED}, cdf as ({_poisson_cdf("(select 0 as c, 0.1::double as rate)")}),
            pixels as (select {_KEYS}, * exclude (gx, gy, col, "row")
                       from joined semi join test_sites using (col, "row")),
            places as (select distinct col, "row", column_index, row_index from pixels),
            hashed as (select *, {_hash("7", *[f'cast("{c}" as varchar)' for c in ("col", "row", "column_index", "row_index")])} as u
                       from places),
            chosen as (select col, "row", column_index, row_index, cast(count(*) as int) as drawn
                       from hashed join cdf on u >= cdf and i < 20 group by all)''',
        'select * from pixels join chosen using (col, "row", column_index, row_index)',
    ),
    "classify": (
        f"{_FEATURES}, {_JOINED}",
        f'''select {_KEYS}, true as sums_to_one, true as agrees
            from joined semi join test_sites using (col, "row") where {_COMPLETE}''',
    ),
    "train_classify": (
        f'''{_FEATURES}, {_JOINED},
        listed as (select col, "row", count(*) as copies
                   from pool p join labelled i on i.name = p.name where usage = 'validate' group by all)''',
        f'''select sum(copies)::bigint as judged, true as tss_agrees, true as recall_agrees, true as auc_in_range
            from joined join listed using (col, "row") join mask using (gx, gy)
            where mask is not null and {_COMPLETE}''',
    ),
    # sampling
    "poisson_sample": (
        f'''cdf as ({_poisson_cdf("(select 0 as c, 0.1::double as rate)")}),
            drawn as (select *, {_hash("7", "cast(gx as varchar)", "cast(gy as varchar)")} as u from scored)''',
        '''select gx, gy, cast(count(*) as int) as drawn from drawn join cdf on u >= cdf and i < 20 group by 1, 2''',
    ),
    "bernoulli_sample": (
        "",
        f'''select name, col, "row" from pool
            where {_hash("42", "cast(col as varchar)", 'cast("row" as varchar)')} < 0.3''',
    ),
    "take_sample": (
        "",
        f'''select name, col, "row" from pool
            order by {_hash("7", "cast(col as varchar)", 'cast("row" as varchar)')}, col + 13800*"row" limit 25''',
    ),
    "balance_samples": (
        f'''rates as (select mask as c, (select count(*) from mask where mask is not null) / (2.0::double * count(*)) as rate
                      from mask where mask is not null group by 1),
            cdf as ({_poisson_cdf("rates")}),
            drawn as (select *, {_hash("7", "cast(gx as varchar)", "cast(gy as varchar)")} as u from mask where mask is not null)''',
        "select gx, gy, mask from drawn join cdf on c = mask and u >= cdf",
    ),
}


def oracle_sql() -> dict[str, str]:
    return {
        name: "with " + VIEWS + (f", {extra}" if extra else "") + "\n" + final
        for name, (extra, final) in QUERIES.items()
    }
