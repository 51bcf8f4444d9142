"""Rollout tables derived from the given tables.

Each entry is SQL that Spark and DuckDB both run. A name in braces is a given table or
another view; double braces are literal ones. All rows of the given tables are used.
"""

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cascadia.session import measured

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

SECRET = "rollout-secret"

_SEP = "chr(10)"
_TAB = "chr(9)"
_QUOTE = "chr(92)||'\"'"

# Step histories: one list of (type, state, output) per outcome, ids count from 1.
_STEPS = {
    0: "Plan+ Request+approve Results Apply+ Success",
    1: "Plan+ Request+reject Results Reject",
    2: "Plan- Reject",
    3: "Plan+ Request- Reject",
    4: "Plan+ Request+approve Results Apply- Reject",
}


def _step_values() -> str:
    names = {"Request": "Request Approval", "Results": "Approval Results"}
    rows = []
    for scenario, path in _STEPS.items():
        step = 0

        def put(kind, state, output=""):
            nonlocal step
            step += 1
            rows.append(f"({scenario}, {step}, '{kind}', '{state}', '{output}')")

        for word in path.split():
            mark = next((m for m in "+-" if m in word), "")
            base, _, answer = word.partition(mark) if mark else (word, "", "")
            state = names.get(base, base)
            kind = "Task" if mark else ("Choice" if base == "Results" else "Pass")
            put(f"{kind}StateEntered", state)
            if mark == "+":
                put("TaskSucceeded", state, f'"{answer}"' if answer else "")
            elif mark == "-":
                put("TaskFailed", state)
            put(f"{kind}StateExited", state)
    return ", ".join(rows)


VIEWS = {
    "account_base": """
        select n_nationkey as account_key, n_name as account_name,
               'live/'||replace(r_name,' ','_')||'/'||n_name as account_path,
               1 + n_nationkey % 3 as min_approval_count, 1 + n_nationkey % 2 as min_rejection_count,
               'arn:plan/'||n_name as plan_role_arn, 'arn:apply/'||n_name as apply_role_arn
        from {nation} join {region} on n_regionkey = r_regionkey""",
    "account_dep": """
        select a.n_name as account_name, b.n_name as dep_name
        from {nation} a join {nation} b on b.n_nationkey = a.n_nationkey - 5""",
    # Teams of an account: one per market segment of the nation's customers.
    "account_voter": """
        select distinct n_name as account_name, lower(c_mktsegment)||'@'||n_name as voter
        from {customer} join {nation} on c_nationkey = n_nationkey""",
    "cfg_node": """
        select p_partkey as cfg_key, account_key, account_name, account_path,
               account_path||'/'||lower(p_type)||'/cfg-'||cast(p_partkey as varchar(20)) as cfg_path,
               p_type, 'registry.example/'||lower(p_brand) as provider
        from {part} join {account_base} on account_key = p_partkey % 25""",
    # Two equality joins instead of one join with "or", which would be a nested loop.
    "cfg_edge": """
        select c.account_name, c.cfg_key, c.cfg_path, d.cfg_path as dep_path, 0 as pos
        from {cfg_node} c join {cfg_node} d on d.cfg_key = c.cfg_key - 25
        where cast(floor(c.cfg_key / 25) as bigint) % 4 <> 0
        union all
        select c.account_name, c.cfg_key, c.cfg_path, d.cfg_path as dep_path, 1 as pos
        from {cfg_node} c join {cfg_node} d on d.cfg_key = c.cfg_key - 50
        where cast(floor(c.cfg_key / 25) as bigint) % 3 = 0""",
    # Graphs of 24 directories; dependencies lead on by a few steps and from the last ones back.
    "loop_edge": """
        select 'graph-'||cast(g as varchar(20)) as graph_id, 'dir/'||cast(p as varchar(20)) as cfg_path,
               'dir/'||cast(case when p + 1 + p * 7 % 5 < 24 then p + 1 + p * 7 % 5 else (g + p) % 19 end as varchar(20)) as dep_path
        from (select cast(floor(c_custkey / 24) as bigint) as g, c_custkey % 24 as p from {customer})
        where (g + p) % 9 <> 8""",
    # Dependencies of a directory on one that depends on it in turn.
    "back_edge": """
        select c.cfg_key, c.cfg_path, d.cfg_path as dep_path
        from {cfg_node} c join {cfg_node} d on d.cfg_key = c.cfg_key + 50
        where cast(floor(c.cfg_key / 25) as bigint) % 4 = 1""",
    "changed_file": """
        select l_suppkey as pr_id, l_orderkey, md5(cast(l_suppkey as varchar(20))) as commit_id, account_name,
               cfg_path||'/f'||cast(l_linenumber as varchar(20))||
               case l_linenumber % 4 when 0 then '.md' when 2 then '.hcl' else '.tf' end as filename,
               case when l_linenumber = 7 and l_linestatus = 'O' then 'renamed'
                    when l_returnflag = 'A' then 'added'
                    when l_returnflag = 'N' then 'modified' else 'removed' end as status
        from {lineitem} join {cfg_node} on cfg_key = l_partkey""",
    # The files of one order are one pull request of its customer's repository.
    "pr_file": """
        select 'org/repo-'||cast(o_custkey as varchar(20)) as repo, l_orderkey as pr_id, filename, status
        from {changed_file} join {orders} on o_orderkey = l_orderkey""",
    "run_base": """
        with r as (
          select l_suppkey, cfg_key, account_key, account_name, account_path, cfg_path, p_type, provider,
                 (l_suppkey*31 + cfg_key*17 + 16*cast(floor(cfg_key/25) as bigint)) % 20 as h,
                 (l_suppkey + cast(floor(account_key/5) as int)) % 3 as g
          from (select distinct l_suppkey, l_partkey from {lineitem}) join {cfg_node} on cfg_key = l_partkey)
        select l_suppkey as pr_id, md5(cast(l_suppkey as varchar(20))) as commit_id, cfg_key, account_key,
               account_name, account_path, cfg_path, provider,
               'run-'||cast(l_suppkey as varchar(20))||'-'||cast(cfg_key as varchar(20)) as execution_id,
               false as is_rollback,
               case when g = 0 or h > 5 then 'succeeded' when h < 3 then 'waiting' when h = 3 then 'running'
                    when h = 4 then 'failed' else 'aborted' end as status,
               case when (l_suppkey + cast(floor(cfg_key/25) as bigint)) % 3 <> 0 then 'res_'||lower(p_type)||'.r'||cast(cfg_key as varchar(20))
                    end as resource_a,
               case when (l_suppkey + cast(floor(cfg_key/25) as bigint)) % 6 = 1 then 'res_extra.x'||cast(cfg_key as varchar(20)) end as resource_b
        from r""",
    "vote": """
        select event_id as vote_id, ts, 'run-'||cast(user_id as varchar(20)) as execution_id,
               'voter-'||cast(event_id % 7 as varchar(20)) as voter,
               case when event_type in ('click','purchase') then 'approve' else 'reject' end as action
        from {events}""",
    "vote_run": """
        select distinct 'run-'||cast(user_id as varchar(20)) as execution_id,
               cast(2 + user_id % 3 as int) as min_approval_count,
               cast(2 + user_id % 4 as int) as min_rejection_count,
               case when user_id % 4 = 0 then 'voter-0' end as first_approval,
               case when user_id % 5 = 0 then 'voter-1' end as first_rejection,
               case when user_id % 6 = 0 then 'SUCCEEDED' when user_id % 7 = 0 then 'ABORTED' else 'RUNNING' end as live_status
        from {events}""",
    # Webhook events: one per order, with missing fields and bad signatures among them.
    "webhook_body": """
        select o_orderkey as event_id, o_orderdate as ts,
               case when o_orderkey % 13 = 0 then 'prefix' when o_orderkey % 17 = 0 then 'digest' else 'good' end as sig_kind,
               case when o_orderkey % 19 = 0 then 'push' else 'pull_request' end as event_kind,
               '{{"action":"'||case o_orderkey % 6 when 0 then 'opened' when 1 then 'edited' when 2 then 'reopened'
                    when 5 then 'synchronize' else 'closed' end||
               '","zen":"x","repository":{{"full_name":"org/repo-'||cast(o_custkey as varchar(20))||
               '","id":1}},"pull_request":{{"merged":'||case when o_orderkey % 6 = 3 then 'true' else 'false' end||
               case when o_orderkey % 11 = 0 then '' else ',"number":'||cast(o_orderkey as varchar(20)) end||
               ',"base":{{"sha":"b'||cast(o_orderkey as varchar(20))||'","ref":"trunk"}},"head":{{"sha":"'||
               md5(cast(o_orderkey as varchar(20)))||'","ref":"feature-'||cast(o_orderkey as varchar(20))||'"}}}}}}' as body
        from {orders}""",
    # Finished-run events: one per line item, so a run may get several.
    "run_event": """
        select cast(l_orderkey as varchar(20))||'-'||cast(l_linenumber as varchar(20))||'-'||
               cast(l_suppkey as varchar(20))||'-'||cast(l_partkey as varchar(20)) as event_id,
               l_shipdate as ts, 'aws.states' as source,
               case when l_linenumber = 6 then 'Tag Change' else 'Step Functions Execution Status Change' end as detail_type,
               case when l_quantity > 49 then 'TIMED_OUT' when l_returnflag = 'A' then 'ABORTED'
                    when l_returnflag = 'N' then 'SUCCEEDED' else 'FAILED' end as status,
               'run-'||cast(l_suppkey as varchar(20))||'-'||cast(l_partkey as varchar(20)) as execution_id,
               case when l_linenumber = 5 then 'true' else 'false' end as is_rollback,
               md5(cast(l_suppkey as varchar(20))) as commit_id, 'dir-'||cast(l_partkey as varchar(20)) as cfg_path
        from {lineitem}""",
    "run_event_doc": """
        select event_id, ts, source, detail_type, status,
               '{{"execution_id":"'||execution_id||'","is_rollback":'||is_rollback||',"commit_id":"'||commit_id||
               '","cfg_path":"'||cfg_path||'","status":"waiting"}}' as input,
               case when status in ('ABORTED','TIMED_OUT') then null else
               '{{"execution_id":"'||execution_id||'","is_rollback":'||is_rollback||',"commit_id":"'||commit_id||
               '","cfg_path":"'||cfg_path||'","status":"'||lower(status)||'","extra":[1]}}' end as output
        from {run_event}""",
    # The same deliveries with few failures, so that only some commits break.
    "rare_failure": """
        select cast(l_orderkey as varchar(20))||'-'||cast(l_linenumber as varchar(20))||'-'||
               cast(l_suppkey as varchar(20))||'-'||cast(l_partkey as varchar(20)) as event_id,
               l_shipdate as ts, 'run-'||cast(l_suppkey as varchar(20))||'-'||cast(l_partkey as varchar(20)) as execution_id,
               case when (l_partkey + l_orderkey) % 701 = 0 then 'failed' when (l_partkey + l_orderkey) % 709 = 0 then 'aborted'
                    else 'succeeded' end as status,
               l_linenumber = 5 as is_rollback, md5(cast(l_suppkey as varchar(20))) as commit_id
        from {lineitem}""",
    "state_doc": f"""
        select execution_id,
               case when cfg_key % 7 = 0 then '' else
               '{{{{"version":4,"resources":[{{{{"type":"aws_a","name":"r'||cast(cfg_key as varchar(20))||
               '","provider":"provider['||{_QUOTE}||provider||{_QUOTE}||']"}}}},{{{{"type":"aws_b","name":"other","provider":"provider['||
               {_QUOTE}||'registry.example/none'||{_QUOTE}||'].x"}}}},{{{{"type":"aws_c","name":"s'||cast(pr_id as varchar(20))||
               '","provider":"provider['||{_QUOTE}||provider||{_QUOTE}||'].east","instances":[]}}}}]}}}}' end as doc
        from {{run_base}}""",
    "graph_log": f"""
        select n.account_name as graph_id, '/repo' as root,
               {_TAB}||'"/repo/'||n.cfg_path||'" ;'||
               coalesce({_SEP}||{_TAB}||'"/repo/'||n.cfg_path||'" -> "/repo/'||a.dep_path||'";', '')||
               coalesce({_SEP}||{_TAB}||'"/repo/'||n.cfg_path||'" -> "/repo/'||b.dep_path||'";', '')||{_SEP} as text
        from {{cfg_node}} n
        left join (select * from {{cfg_edge}} where pos = 0) a on a.cfg_path = n.cfg_path
        left join (select * from {{cfg_edge}} where pos = 1) b on b.cfg_path = n.cfg_path""",
    "provider_log": f"""
        select account_name as graph_id, cfg_path,
               'Providers required by configuration:'||{_SEP}||'.'||{_SEP}||'├── provider['||provider||'] ~> 3.0'||{_SEP}||
               '└── provider[registry.example/base]'||{_SEP}||{_SEP}||'Providers required by state:'||{_SEP}||{_SEP}||
               '  provider[registry.example/base]'||{_SEP}||
               case when cfg_key % 3 = 0 then '    provider['||provider||']'||{_SEP} else '' end as text
        from {{cfg_node}}""",
    # One plan log per commit and directory.
    "plan_log": f"""
        select commit_id, account_name as graph_id, '/repo' as root,
               case when cfg_key % 29 = 0 then 1 when cfg_key % 2 = 0 then 2 else 0 end as returncode,
               'time=now level=error'||{_SEP}||
               case when cfg_key % 2 = 0 then
                 'exit status 2'||{_SEP}||{_SEP}||' prefix=[/repo/'||cfg_path||'] '||{_SEP}||
                 'exit status 2'||{_SEP}||{_SEP}||' prefix=[/repo/shared/'||account_name||'] '||{_SEP}
               else 'exit status 1'||{_SEP}||{_SEP}||' prefix=[/repo/'||cfg_path||'] ' end as text
        from {{run_base}}""",
    "plan_text": f"""
        select 'run-'||cast(doc_id as varchar(20)) as execution_id,
               'Changes to Outputs:'||{_SEP}||'  ~ '||
               replace(replace(replace(text, '. ', '.'||{_SEP}||'  + '), ', ', ','||{_SEP}||{_SEP}||{_TAB}||'   - '),
                       '! ', '!'||{_SEP}||'~ ') as text
        from {{documents}}""",
    "step_event": f"""
        select 'run-'||cast(o_orderkey as varchar(20)) as execution_id, s.id, s.type, s.state, s.output
        from {{orders}} join (values {_step_values()}) as s(scenario, id, type, state, output)
          on o_orderkey % 5 = s.scenario""",
    "delivery": """
        select 'run-'||cast(l_orderkey as varchar(20)) as execution_id,
               'voter-'||cast(l_linenumber as varchar(20)) as voter,
               case when l_returnflag = 'R' and l_linestatus = 'O' then 'MessageRejected' else 'Success' end as status
        from {lineitem}""",
    "commit_status": """
        select md5(cast(l_orderkey as varchar(20))) as commit_id,
               case when l_linenumber = 7 then 'merge lock' else 'Plan: dir-'||cast(l_linenumber as varchar(20)) end as context,
               case when l_linenumber % 2 = 0 then 'PrPlan' when l_linenumber = 7 then 'MergeLock'
                    when l_linenumber = 1 then 'Apply' else 'Plan' end as component,
               case when l_linestatus = 'O' then 'pending' when l_returnflag = 'R' then 'failure' else 'success' end as state,
               l_shipdate as ts, l_partkey*100000 + l_suppkey as status_id
        from {lineitem}""",
    "log_event": """
        select event_type as log_group, 'stream-'||cast(user_id as varchar(20)) as stream, ts, event_id,
               case when event_id % 3 = 0 then 'ERROR value '||cast(event_id as varchar(20)) else 'INFO ok' end as message
        from {events}""",
    "build": """
        select n_name as repo, s_suppkey as pr_id,
               s_suppkey * 7919 % 100003 as ts,
               case when s_suppkey % 10 = 0 then 'failed' when s_suppkey % 7 = 0 then 'started' else 'succeeded' end as state
        from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "account_update": """
        select case when c_custkey % 40 = 0 then 'NEW_'||c_mktsegment else n_name end as account_name,
               case when c_custkey % 3 = 0 then null else 'moved/'||c_mktsegment||'/'||n_name end as account_path,
               cast(c_custkey % 5 as int) as min_approval_count, cast(c_custkey % 4 as int) as min_rejection_count,
               'arn:plan/new-'||cast(c_custkey as varchar(20)) as plan_role_arn, c_custkey as seq
        from {customer} join {nation} on c_nationkey = n_nationkey
""",
}


# Measured first, as nearly all views join it: a guess too large would have directories and runs
# dealt out by an account's key, of which there may be few.
STORED = ("account_base",)


def references(sql: str) -> list[str]:
    """Tables and views a text names, each once."""
    names = [name for _, name, _, _ in string.Formatter().parse(sql) if name]
    return list(dict.fromkeys(names))


class Tables:
    """Given tables and derived views as DataFrames of one session and folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            if name in STORED:
                self._known[name] = measured(self.sql(VIEWS[name]))
            elif name in VIEWS:
                self._known[name] = self.sql(VIEWS[name])
            else:
                self._known[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._known[name]

    def once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """What ``make`` gives, made once under a ``name`` that is no table's."""
        key = f"({name})"
        if key not in self._known:
            self._known[key] = make()
        return self._known[key]

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{name: self[name] for name in references(text)})


def with_views(text: str) -> str:
    """DuckDB text: the views a query names as common table expressions before it."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in VIEWS and name not in order:
            for inner in references(VIEWS[name]):
                visit(inner)
            order.append(name)

    for name in references(text):
        visit(name)

    if text.lstrip().startswith("with "):
        text = f"select * from ({text})"

    def plain(sql: str) -> str:
        return sql.format(**{n: n for n in references(sql)})

    if not order:
        return plain(text)
    views = ",\n".join(f"{name} as ({plain(VIEWS[name])})" for name in order)
    return f"with recursive {views}\n{plain(text)}"
