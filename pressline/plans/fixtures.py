"""Inputs for the queries, composed from the test tables by SQL that Spark and DuckDB both run.

Only the CTE that numbers lines differs. All rows and whole texts of a table are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LINES = {
    "spark": "l as (select doc_id, source, cast(i as int) i, line from documents lateral view posexplode(split(text, '\\n')) e as i, line)",
    "duckdb": "d0 as (select doc_id, source, string_split(text, chr(10)) ls from documents), l as (select doc_id, source, cast(unnest(range(len(ls))) as int) i, unnest(ls) line from d0)",
}

#: name -> (fixtures it needs, its CTEs)
FIXTURES: dict[str, tuple[list[str], str]] = {
    "blocks": (
        ["l"],
        """blocks as (select source as issue_id, doc_id, i, line as text_normalized,
 case when i%5=0 then 'SectionHeader' when i%11=7 then 'PageFooter' when i%13=9 then 'PageHeader' else 'Text' end as label,
 cast((floor(i/6)%3)*400 as double) x0, cast((i%6)*120+(length(line)%7)*20 as double) y0,
 cast((floor(i/6)%3)*400+300+(length(line)%5)*40 as double) x1, cast((i%6)*120+(length(line)%7)*20+60 as double) y1 from l)""",
    ),
    "boxes": (["blocks"], "boxes as (select doc_id, i as box_no, i as position, case when i%7=3 then 'Picture' when i%7=5 then 'Table' else 'Text' end as label, x0, y0, x1, y1 from blocks)"),
    "ln": (
        ["blocks"],
        """ks as (select k from (values (0),(1),(2),(3),(4),(5)) t(k)),
 ln as (select doc_id, i*6+k as line_no, 'line '||cast(i as varchar(9))||'-'||cast(k as varchar(9)) as text,
   cast((doc_id*31+i*7+k)%100 as double)/128 as confidence, case when (i+k)%3=0 then 'embedded' else 'surya' end as source,
   x0 + (k*7)%40 - 10 as x0, y0+9*k as y0, x1 + case when (doc_id+i+k)%9=0 then 200 else -5 end as x1, y0+9*k+8 as y1
   from blocks cross join ks where k < (i+doc_id)%7)""",
    ),
    "emb": (["ln"], "emb as (select doc_id, line_no, 'embedded reading of '||text as text, x0+4 as x0, y0+3 as y0, x1+4 as x1, y1+3 as y1 from ln where line_no%5<>0)"),
    # the same with lines that the rules reject, long ones, and some that lie apart in pairs
    "read2": (
        ["ln"],
        """read2 as (select doc_id, line_no, case when line_no%10=4 then repeat('same words here ', 6) when line_no%17=9 then '##%%' else text end as text, confidence, x0, y0 + case when line_no%7=2 then 3000+line_no%3 else 0 end as y0,
   x1 + case when line_no%19=3 then 900 else 0 end as x1, y1 + case when line_no%7=2 then 3000+line_no%3 else 0 end as y1 from ln)""",
    ),
    "emb2": (
        ["emb"],
        """emb2 as (select doc_id, line_no, case when line_no%11=3 then '. . 7 .' when line_no%11=7 then repeat('the same words again ', 5) when line_no%23=6 then '&&&&&&&& of it' else text end as text,
   x0 + case when line_no%13=6 then 4000 else 0 end as x0, y0, x1 + case when line_no%13=6 then 4000 when line_no%29=11 then 300 else 0 end as x1, y1 + case when line_no%31=4 then 90 else 0 end as y1 from emb)""",
    ),
    "breaks": (
        [],
        """breaks as (select doc_id, n, case n when 0 then substr(text,1,20)||'-' when 1 then lower(substr(text,21,20)) when 2 then case when doc_id%2=0 then '   ' else '|' end when 3 then lower(substr(text,41,15))||'.' else 'X'||substr(text,56) end as line
 from documents cross join (values (0),(1),(2),(3),(4)) t(n))""",
    ),
    "noise": (
        ["l"],
        "noise as (select doc_id, i, case when (doc_id+i)%5=0 then repeat(line||' ',4) when (doc_id+i)%5=1 then '..'||substr(line,1,2) when (doc_id+i)%5=2 then '####'||substr(line,1,4)||'$$$$' when (doc_id+i)%5=3 then '12345 67890 1234 '||cast(doc_id as varchar(9)) else line end line from l)",
    ),
    "heads": (
        [],
        """heads as (select o_orderkey, v, place, case v when 0 then 'THE DAILY TIMES'||chr(10)||place||dow||', '||mon||' '||dd||', '||yy
 when 1 then place||dd||'th '||mon||'. '||yy when 2 then place||mon||' '||dd||', Tl'||substr(yy,2,3)
 when 3 then place||mon||' 45, '||yy when 4 then place||mon||' '||dd||' Price 5 Cents'
 when 5 then city||', '||dow||', '||mon||' '||dd||', '||yy when 6 then '12 Main St. '||city||', NB 04101'
 when 7 then 'VOL. '||substr('IVXIVXI',1,2)||' NO. '||dd when 8 then 'No. '||dd||' - 41 ST YEAR' else 'VOL. 12.'||dd end as header_text
 from (select o_orderkey, o_orderkey%10 v, cast(year(o_orderdate) as varchar(4)) yy, cast(day(o_orderdate) as varchar(2)) dd,
  substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3*cast(month(o_orderdate) as int)-2, 3) mon,
  case o_orderkey%4 when 0 then 'Monday' when 1 then 'Tues' when 2 then 'Friday' else 'Sun' end dow,
  case o_orderkey%3 when 0 then 'Saint John' when 1 then 'BOSTON' else 'St. Paul' end city,
  case o_orderkey%3 when 0 then 'Saint John' when 1 then 'BOSTON' else 'St. Paul' end||', '||case o_orderkey%7 when 0 then 'N.B.' when 1 then 'Mass.' when 2 then 'Ohio' when 3 then 'Ontario' when 4 then 'New York' when 5 then 'Bavaria' else 'Que.' end||', ' place from orders) x)""",
    ),
    "heads6": (
        [],
        """heads6 as (select source as issue_id, cast(pn as int) as page_number, 'PageHeader' as label, 0 as block_seq,
 case when pn%6=5 then 'POOR DOCUMENT' when pn%6=4 then 'SECTION TWO' when pn%6=3 then replace(replace(replace(replace(name,'GRAPH','GRAPM'),'ICLE','ICLF'),'ANER','ANFR'),'ADVE','ADVF') else name end || case when pn%4=0 then ' www.example.com Page '||cast(pn as varchar(9)) else '' end as text_normalized
 from (select source, row_number() over (partition by source order by doc_id) pn,
  case cast(substr(source,4) as int)%4 when 0 then 'THE EVENING TELEGRAPH' when 1 then 'DAILY GLEANER' when 2 then 'MORNING CHRONICLE HERALD' else 'ADVERTISER' end name from documents) x)""",
    ),
    # groups of forty issues, and one that holds a third of all; some mastheads of a group share words,
    # some are too short; some names are misread
    "issues": (
        [],
        """issues as (select cast(doc_id as varchar(9)) as issue_id,
 case doc_id%5 when 0 then 'The Evening Telegraph '||g when 1 then case when doc_id%10=6 then 'Evening Telegraqh ' else 'Evening Telegraph ' end||g when 2 then 'Daily Gleaner '||g when 3 then '' else 'Issue '||cast(doc_id as varchar(9)) end newspaper,
 case doc_id%5 when 3 then 'fallback' when 4 then 'fallback' when 0 then 'page_headers' when 1 then 'page_headers' else 'cross_issue' end newspaper_source,
 case when doc_id%3=0 then 'Saint John' end city, case when doc_id%3=0 then 'N.B.' end province, cast(null as varchar(9)) as country,
 case doc_id%4 when 0 then 'with which incorporated'||g||' morning'||g||' journal'||g||' founded'||g when 1 then 'incorporated'||g||' morning'||g||' journal'||g||' established'||g||' weekly'||g||' review'||g when 2 then 'short title' else 'separate words'||cast(doc_id as varchar(9))||' number'||cast(doc_id as varchar(9))||' masthead'||cast(doc_id as varchar(9))||' entry'||cast(doc_id as varchar(9)) end masthead,
 '19'||cast(50+doc_id%40 as varchar(4))||'-0'||cast(1+doc_id%9 as varchar(1))||case when doc_id%6=0 then '' else '-15' end as date,
 4 + doc_id%5 as page_count, 40 + doc_id%11 as block_count, 10 + doc_id%7 as article_count, cast(doc_id%8 as double)/8 as coverage_min_ratio, cast(null as varchar(9)) as place_source, 't'||cast(doc_id%3 as varchar(9)) as processed_at
 from (select doc_id, case when floor(doc_id/40)%3=0 then '0' else cast(cast(floor(doc_id/40) as bigint) as varchar(9)) end g from documents) x)""",
    ),
    # three pages an issue, on which each source of each field is there or not: file name, header, text layer, bands, inner pages, body
    "flags": (
        [],
        """flags as (select doc_id, 'Coast_Daily_'||cast(doc_id as varchar(9))||case when doc_id%2=0 then '_19100615' else '' end as issue_id, doc_id%2=0 as f0,
 floor(doc_id/2)%2=0 as f1, floor(doc_id/4)%2=0 as f2, floor(doc_id/8)%2=0 as f3, floor(doc_id/16)%2=0 as f4, floor(doc_id/32)%2=0 as f5, floor(doc_id/64)%2=0 as f6,
 doc_id%3=0 as i1, doc_id%5<2 as i2, doc_id%7<3 as i3, doc_id%9<3 as v1, doc_id%10<4 as v2, doc_id%11<5 as v3, doc_id%13<6 as v4,
 doc_id%17<5 as m1, doc_id%19<6 as m2, doc_id%37<12 as n1, doc_id%23<9 as m3, doc_id%25<8 as r3, doc_id%27<10 as m4, doc_id%29<12 as m5, doc_id%31<15 as t1 from documents)""",
    ),
    "fronts": (
        ["flags"],
        """fronts as (select issue_id, 1 as page_number, 10 as y, 'PageHeader' as label, 'THE MORNING HERALD AND NEWS' as text from flags where m1
 union all select issue_id, 1, 30, 'PageHeader', '12 Main St. -- Lowell, MA 01850 -- * * * *' from flags where i1
 union all select issue_id, 1, 50, 'PageHeader', 'BOSTON, Mass., Monday, Jan 2, 1911' from flags where f1
 union all select issue_id, 1, 150, 'Text', 'Fish and Farm Journal' from flags where m3
 union all select issue_id, 1, 200, 'Text', 'TORONTO, Ont., Wednesday, Apr 9, 1913' from flags where f3
 union all select issue_id, 1, 230, 'Text', '9 Dock St. -- Salem, OR 97301 -- * * * *' from flags where i2
 union all select issue_id, 1, 400, 'SectionHeader', 'Fish and Farm Journals' from flags where r3
 union all select issue_id, 1, 450, 'SectionHeader', 'Council will meet again tonight' from flags where t1
 union all select issue_id, 1, 600, 'Text', 'Read on may 5, 1931' from flags where f6
 union all select issue_id, 1, 620, 'Text', 'VOL. 5 NO. 12' from flags where v3
 union all select issue_id, 1, 640, 'Text', 'HARBOUR AND RIVER NEWS' from flags where m5
 union all select issue_id, 1, 700, 'Text', 'Every first page says this' from flags
 union all select issue_id, 2, 10, 'PageHeader', 'EASTERN GAZETTE WEEKLY' from flags where m2
 union all select issue_id, 2, 30, 'PageHeader', 'VOL. 6 NO. 13' from flags where v4
 union all select issue_id, 2, 50, 'PageHeader', 'MONTREAL, Que., Friday, Mar 6, 1914' from flags where f4
 union all select issue_id, 3, 10, 'PageHeader', 'EASTERN GAZETTE WEEKLY' from flags where n1
 union all select issue_id, 1, 40, 'Layer', 'HALIFAX, N.S., Wednesday, Feb 7, 1912' from flags where f2
 union all select issue_id, 1, 60, 'Layer', '7 King St. -- Truro, NS B2N 5Y1 -- * * * *' from flags where i3
 union all select issue_id, 1, 80, 'Layer', 'VOL. 3 NO. 10' from flags where v1
 union all select issue_id, 1, 400, 'Layer', 'Printed on april 11, 1921' from flags where f5
 union all select issue_id, 1, 420, 'Layer', 'VOL. 4 NO. 11' from flags where v2
 union all select issue_id, 1, 440, 'Layer', 'ATLANTIC SHIPPING LIST' from flags where m4)""",
    ),
    "stories": (
        [],
        """stories as (select issue_id, page_number, article_seq, 'p'||cast(page_number as varchar(9))||'a00'||cast(article_seq as varchar(9)) article_id,
 case when article_seq=1 then 'Lead story Continued on Page '||case when page_number%3=0 then 'two' when page_number%3=1 then cast(page_number+1 as varchar(9)) else 'ninety' end
      when article_seq=2 then 'continued  from page '||cast(page_number-1 as varchar(9))||' rest'
      when article_seq=3 and page_number%4=0 then 'continued from page '||cast(page_number-1 as varchar(9)) else 'plain' end text_normalized
 from (select source issue_id, cast(row_number() over (partition by source order by doc_id) as int) page_number from documents) x cross join (values (1),(2),(3)) t(article_seq))""",
    ),
    "answers": (
        [],
        """answers as (select conv_id, turn, case turn%4 when 0 then 'Here is'||chr(10)||'Output:'||chr(10)||text when 1 then '```text'||chr(10)||text||chr(10)||'```' when 2 then text||' '||text else substr(text,1,greatest(1,cast(floor(length(text)/5) as int))) end resp, text from conversations)""",
    ),
}


def ctes(engine: str, *names: str) -> str:
    """`with ...` that defines the fixtures and what they need, each once."""
    done: list[str] = []

    def add(name: str) -> None:
        if name in done:
            return
        for need in FIXTURES[name][0] if name != "l" else []:
            add(need)
        done.append(name)

    for name in names:
        add(name)
    return "with " + ",\n ".join(LINES[engine] if n == "l" else FIXTURES[n][1] for n in done)


def fixture(spark: SparkSession, sf_dir: str, name: str, select: str = "*") -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "orders", "conversations")}
    query = ctes("spark", name) + f"\nselect {select} from {name}"
    for t in tables:
        query = query.replace(f"from {t}", f"from {{{t}}}") if f"from {t}" in query else query
    used = {t: df for t, df in tables.items() if f"{{{t}}}" in query}
    return spark.sql(query, **used)
