"""DuckDB SQL with the result of each registered query."""

from cascadia import model as M
from cascadia.model import FILE_PATH_PATTERN
from cascadia.plans.queries import APPROVAL_URL
from cascadia.plans.views import SECRET, with_views


def _hmac(message: str) -> str:
    key = SECRET.encode().ljust(64, b"\0")
    inner = bytes(b ^ 0x36 for b in key).hex()
    outer = bytes(b ^ 0x5C for b in key).hex()
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({message}))))"


def _link(value: str) -> str:
    def quoted(text):
        return f"replace(url_encode({text}), '%20', '+')"

    once = f"replace({quoted(value)}, '+', ' ')"
    return f"replace({quoted(once)}, '%', '$')"


_SIGNATURE = f"""case sig_kind when 'prefix' then 'sha1='||{_hmac('body')} when 'digest' then 'sha256='||md5(body)
  else 'sha256='||{_hmac('body')} end"""

_SIG_ERROR = """case when sig_kind = 'prefix' then 'Signature is not a valid sha256 value'
  when sig_kind = 'digest' then 'Header signature and expected signature do not match' end"""

_EVENT_FIELDS = """select event_id, ts, sig_kind, event_kind,
  json_extract_string(body, '$.repository.full_name') as repo,
  json_extract_string(body, '$.action') as action,
  json_extract_string(body, '$.pull_request.merged') = 'true' as merged,
  try_cast(json_extract_string(body, '$.pull_request.number') as bigint) as number,
  json_extract_string(body, '$.pull_request.base.ref') as base_ref,
  json_extract_string(body, '$.pull_request.base.sha') as base_sha,
  json_extract_string(body, '$.pull_request.head.ref') as head_ref,
  json_extract_string(body, '$.pull_request.head.sha') as head_sha
  from {webhook_body}"""

_ROUTE = """case when action in ('opened','edited','reopened') and not merged then 'open'
  when action = 'closed' and merged then 'merge' end"""

_PARSE_ERROR = """case when event_kind <> 'pull_request' then 'Event is not a pull request'
  when number is null then 'missing: number' end"""

_EVENT_CHECKED = f"""select *, {_ROUTE} as route, {_PARSE_ERROR} as parse_error, {_SIG_ERROR} as sig_error,
  exists (select 1 from {{pr_file}} f where f.repo = e.repo and f.pr_id = e.number
    and regexp_matches(f.filename, '{FILE_PATH_PATTERN}')) as matched
  from ({_EVENT_FIELDS}) e"""

_EVENT_CODE = """case when route is null then 404 when sig_error is not null then 403
  when number is not null and not matched then 200 when parse_error is not null then 400 else 200 end"""

_CONFIG_DIR = "regexp_replace(filename, '/[^/]*$', '')"
_IS_CONFIG = "(filename like '%.hcl' or filename like '%.tf')"

_SEEDS = f"""select distinct commit_id, b.account_name as graph_id, {_CONFIG_DIR} as dir
  from {{changed_file}} f join {{account_base}} b on starts_with(f.filename, b.account_path||'/')
  where {_IS_CONFIG} and status in ('added','modified','removed')"""

_CLOSURE = f"""select distinct c.commit_id, c.graph_id, c.dir as cfg_path from (
  with recursive reach as (
    {_SEEDS}
    union
    select r.commit_id, r.graph_id, e.cfg_path from reach r
    join {{cfg_edge}} e on e.account_name = r.graph_id and e.dep_path = r.dir)
  select * from reach) c
  join {{cfg_node}} n on n.account_name = c.graph_id and n.cfg_path = c.dir"""

_CFG_BLOCKED = """select distinct r.execution_id from {run_base} r
  join {cfg_edge} e on e.cfg_key = r.cfg_key
  join {run_base} p on p.commit_id = r.commit_id and p.cfg_path = e.dep_path
  where r.status = 'waiting' and p.status <> 'succeeded'"""

_ACCOUNT_BLOCKED = """select distinct r.execution_id from {run_base} r
  join {account_dep} d on d.account_name = r.account_name
  join (select distinct commit_id, account_name from {run_base} where status <> 'succeeded') p
    on p.commit_id = r.commit_id and p.account_name = d.dep_name
  where r.status = 'waiting'"""

_READY = f"""select commit_id, is_rollback, execution_id from {{run_base}}
  where status = 'waiting' and execution_id not in ({_CFG_BLOCKED})
  and execution_id not in ({_ACCOUNT_BLOCKED})"""

_TEAMS = """select account_name, string_agg(voter, '|' order by voter) as voters
  from {account_voter} group by account_name"""

_REPO_RUN = """select r.*, n_name as repo from {run_base} r
  join {supplier} on s_suppkey = r.pr_id join {nation} on n_nationkey = s_nationkey"""

_LOCK = f"""select b.repo, case when b.state = 'started' or (b.state = 'succeeded' and coalesce(busy, false))
  then cast(b.pr_id as varchar) else 'none' end as lock_value
  from (select *, row_number() over (partition by repo order by ts desc, pr_id desc) as k from {{build}}) b
  left join (select repo, bool_or(status in ('waiting','running')) as busy from ({_REPO_RUN}) group by repo) u
    on u.repo = b.repo
  where k = 1"""

_MIXED = """select *, (status = 'aborted' and pr_id % 3 = 0 and resource_b is not null) as mixed from {run_base}"""

_FINISHED = """select *, lower(status) as new_status from {run_event}
  where detail_type = 'Step Functions Execution Status Change' and status in ('SUCCEEDED','FAILED','ABORTED')"""

_RARE_BROKEN = """select distinct commit_id from {rare_failure}
  where status in ('failed','aborted') and not is_rollback"""

# Rollback rows of the commits in `broken`, none of which has one yet.
_CREATED = """select * from {run_base} where resource_a is not null or resource_b is not null"""

_FLAGS = """coalesce(' -target '||resource_a, '')||coalesce(' -target '||resource_b, '')"""


def _run_id(kind: str, pr: str, commit: str, account: str, path: str) -> str:
    return (
        f"'{kind}'||cast({pr} as varchar)||'-'||substr({commit},1,4)||'-'||{account}||'-'||"
        f"regexp_replace({path}, '.*/', '')||'-'||substr(md5('{kind}|'||{commit}||'|'||{path}),1,12)"
    )


# One vote request per running run, voter and action; its kind says how it is tampered with.
_REQUESTS = """select execution_id||voter||x.action as vote_id, execution_id, commit_id, voter, x.action,
    substr(md5(execution_id||voter||x.action), 1, 1) as kind, substr(md5(execution_id), 1, 1) as run_kind
  from {run_base} r join {account_voter} v on v.account_name = r.account_name
  cross join (values ('approve'), ('reject')) as x(action) where status = 'running'"""

_VOTE_SIG_ERROR = f"""case when kind = '0' then '{M.BAD_SIGNATURE_KIND}'
    when kind = '1' and action = 'approve' then '{M.BAD_SIGNATURE}' end"""


# Votes with the sizes of both sides after each; seeds count as earlier votes.
_TALLY = """select v.*, m.min_approval_count, m.min_rejection_count,
    (m.first_approval is not null)::int + sum(case when action = 'approve' and not had_a then 1
      when action = 'reject' and had_a then -1 else 0 end) over w as n_approve,
    (m.first_rejection is not null)::int + sum(case when action = 'reject' and not had_r then 1
      when action = 'approve' and had_r then -1 else 0 end) over w as n_reject
  from (select v.*, case when before is null then coalesce(voter = first_approval, false) else before = 'approve' end as had_a,
               case when before is null then coalesce(voter = first_rejection, false) else before = 'reject' end as had_r
        from (select *, lag(action) over (partition by execution_id, voter order by ts, vote_id) as before from {vote}) v
        join {vote_run} s on s.execution_id = v.execution_id) v
  join {vote_run} m on m.execution_id = v.execution_id
  window w as (partition by v.execution_id order by v.ts, v.vote_id rows unbounded preceding)"""

_DECIDED = f"""select * from (select *, row_number() over (partition by execution_id order by ts, vote_id) as k
  from ({_TALLY}) where n_approve = min_approval_count or n_reject = min_rejection_count) where k = 1"""


def _hashed(key: str, what: str, n: int) -> str:
    return f"substr(md5('0|'||{key}||'|{what}'),1,{n})"


def _one_or_two(key: str, what: str) -> str:
    return f"cast(1 + ('0x'||{_hashed(key, what, 8)})::bigint % 2 as int)"


_ROW = "cast(o_orderkey as varchar)"

def _numbered_on(order: str) -> str:
    """PR numbers of rows added one by one: the unset ones so far, over the highest start among what
    existed and each given number less the unset ones before it."""
    unset = f"sum((given is null)::int) over (order by {order} rows unbounded preceding)"
    return f"""select * exclude (unset), cast(coalesce(given, unset + greatest((select max(pr_id) from {{run_base}}),
        max(given - unset) over (order by {order} rows unbounded preceding))) as int) as pr_id
      from (select *, {unset} as unset from rows_given)"""


_DEFAULTS = f"""
  with rows_given as (
    select *, coalesce(given_dir, coalesce(known_path, account_name)||'/'||{_hashed('k', 'dir', 7)}) as dir
    from (select o_orderkey as row_key, {_ROW} as k, o_orderkey % 2 = 0 as rb,
      coalesce(given_name, 'account-'||{_hashed(_ROW, 'name', 3)}) as account_name,
      b.account_path as known_path, b.plan_role_arn as known_plan, b.apply_role_arn as known_apply,
      cast(case when o_orderkey % 3 = 0 then o_orderkey + 7 end as int) as given,
      case when o_orderkey % 4 = 0 then 'c'||{_ROW} else {_hashed(_ROW, 'commit', 32)} end as commit_id,
      case when o_orderkey % 7 = 0 then 'other' else 'trunk' end as base_ref,
      case when o_orderkey % 2 = 0 then 'feature' else (select min('feature-'||pr_id) from {{run_base}}) end as head_ref,
      case when o_orderkey % 6 = 0 then 'dir/'||{_ROW} end as given_dir,
      case when o_orderkey % 9 = 0 then 'waiting' end as given_status,
      case when o_orderkey % 11 = 0 then 'plan it' end as given_plan,
      coalesce(case when o_orderkey % 8 = 0 then cast(o_orderkey % 4 as int) end, b.min_approval_count,
               {_one_or_two(_ROW, 'approval')}) as a,
      coalesce(b.min_rejection_count, {_one_or_two(_ROW, 'rejection')}) as r,
      case when o_orderkey % 10 = 1 then [] else [o_orderpriority, o_orderstatus] end as list,
      case when o_orderkey % 10 = 1 then 0 else 2 end as n_voters
    from (select *, case when o_orderkey % 5 <> 0 then 'NATION_'||cast(o_custkey % 30 as varchar) end as given_name from {{orders}})
    left join {{account_base}} b on b.account_name = given_name))
  select row_key, account_name, coalesce(known_path, account_name) as account_path,
    'run-'||{_hashed('k', 'id', 7)} as execution_id, commit_id, pr_id, base_ref, head_ref, dir as cfg_path,
    case when given_status is not null then given_status
         when least(n_voters, a) = a then 'succeeded' when least(n_voters, r) = r then 'failed' end as status,
    coalesce(given_plan, 'terragrunt '||case when rb then 'destroy' else 'plan' end||' --terragrunt-working-dir '||dir) as plan_command,
    'terragrunt '||case when rb then 'destroy' else 'apply' end||' --terragrunt-working-dir '||dir||' -auto-approve' as apply_command,
    a as min_approval_count, r as min_rejection_count,
    coalesce(known_plan, account_name||'-plan-role') as plan_role_arn,
    coalesce(known_apply, account_name||'-deploy-role') as apply_role_arn,
    array_to_string(list, '|') as voters, array_to_string(list[1:a], '|') as approval_voters,
    array_to_string(list[1:r], '|') as rejection_voters
  from ({_numbered_on('row_key')})"""

# Wave of a run: the largest k for which it is reached; what runs now counts as 1.
_WAVES = """
  with recursive pend as (select r.*, d.dep_name from {run_base} r
      left join {account_dep} d on d.account_name = r.account_name where status <> 'succeeded'),
  dep as (
    select w.commit_id, w.execution_id, p.execution_id as on_id from pend w
    join {cfg_edge} e on e.cfg_key = w.cfg_key join pend p on p.commit_id = w.commit_id and p.cfg_path = e.dep_path
    where w.status = 'waiting'
    union
    select w.commit_id, w.execution_id, p.execution_id from pend w
    join pend p on p.commit_id = w.commit_id and p.account_name = w.dep_name where w.status = 'waiting'),
  stuck as (
    select execution_id from pend where status in ('failed','aborted')
    union
    select d.execution_id from stuck s join dep d on d.on_id = s.execution_id),
  reach as (
    select execution_id, 1 as k from pend where status in ('waiting','running')
    union
    select d.execution_id, r.k + 1 from reach r join dep d on d.on_id = r.execution_id)
  select p.commit_id, p.execution_id,
    case when s.execution_id is null then cast(m.k as int) end as wave, s.execution_id is not null as blocked
  from pend p left join stuck s on s.execution_id = p.execution_id
  join (select execution_id, max(k) as k from reach group by 1) m on m.execution_id = p.execution_id
  where p.status = 'waiting'"""

# Who waits for whom, over all runs between; back edges close cycles.
_REASONS = """
  with recursive pend as (select r.*, d.dep_name from {run_base} r
      left join {account_dep} d on d.account_name = r.account_name where status <> 'succeeded'),
  edge as (select cfg_key, dep_path from {cfg_edge} union select cfg_key, dep_path from {back_edge}),
  dep as (
    select w.execution_id, p.execution_id as on_id, p.status from pend w
    join edge e on e.cfg_key = w.cfg_key join pend p on p.commit_id = w.commit_id and p.cfg_path = e.dep_path
    where w.status = 'waiting'
    union
    select w.execution_id, p.execution_id, p.status from pend w
    join pend p on p.commit_id = w.commit_id and p.account_name = w.dep_name where w.status = 'waiting'),
  r as (select * from dep union select r.execution_id, d.on_id, d.status from r join dep d on d.execution_id = r.on_id),
  looped as (select execution_id from r where execution_id = on_id),
  flags as (
    select execution_id, bool_or(execution_id = on_id) as on_cycle, bool_or(status in ('failed', 'aborted')) as behind_failure
    from r group by 1),
  behind as (
    select distinct r.execution_id from r join looped l on l.execution_id = r.on_id
    where not exists (select 1 from r b where b.execution_id = r.on_id and b.on_id = r.execution_id))
  select commit_id, p.execution_id, on_cycle, b.execution_id is not null as behind_cycle, behind_failure
  from pend p join flags f on f.execution_id = p.execution_id left join behind b on b.execution_id = p.execution_id
  where p.status = 'waiting' and (on_cycle or behind_failure or b.execution_id is not null)"""

_MARKED = r"""regexp_replace(regexp_replace(text, '(?m)^([^\S ]*) (\s*)([+\-~])', '\1\3\2 ', 'g'),
  '(?m)^([^\S ]*)~', '\1!', 'g')"""


def _lines(marker: str) -> str:
    return (
        "(select count(*) from unnest(string_split(d, chr(10))) as u(line) "
        f"where regexp_matches(line, '^[\\t\\r\\f\\v]*{marker}'))"
    )


# Written without braces, so the text of the pattern needs no doubling.
_SQL = {
    "account_upsert": """
      select account_name, account_path, cast(min_approval_count as int) as min_approval_count,
             cast(min_rejection_count as int) as min_rejection_count, voters, plan_role_arn, apply_role_arn
      from (select account_name, account_path, min_approval_count, min_rejection_count, '' as voters,
                   plan_role_arn, 'arn:apply/new' as apply_role_arn,
                   row_number() over (partition by account_name order by seq desc) as k from {account_update})
      where k = 1
      union all
      select b.account_name, account_path, min_approval_count, min_rejection_count, coalesce(voters, ''),
             plan_role_arn, apply_role_arn
      from {account_base} b left join (%s) v on v.account_name = b.account_name
      where b.account_name not in (select account_name from {account_update})"""
    % _TEAMS,
    "account_scan": """
      select b.account_name, account_path, cast(case when dep_name is null then 0 else 1 end as int) as n_deps,
             coalesce(dep_name, '') as account_deps, coalesce(voters, '') as voters
      from {account_base} b left join {account_dep} d on d.account_name = b.account_name
      left join (%s) v on v.account_name = b.account_name"""
    % _TEAMS,
    "changed_file_scan": """
      select pr_id, commit_id, filename, status from {changed_file} where status <> 'renamed'""",
    "webhook_scan": f"""
      select event_id, ts, repo, action, merged, number, base_ref, base_sha, head_ref, head_sha,
             {_PARSE_ERROR} as parse_error from ({_EVENT_FIELDS})""",
    "run_event_scan": """
      select event_id, ts, json_extract_string(doc, '$.execution_id') as execution_id,
             case when output is null then lower(status) else json_extract_string(doc, '$.status') end as status,
             json_extract_string(doc, '$.is_rollback') = 'true' as is_rollback,
             json_extract_string(doc, '$.commit_id') as commit_id, json_extract_string(doc, '$.cfg_path') as cfg_path,
             cast(null as varchar) as error
      from (select *, coalesce(output, input) as doc from {run_event_doc})""",
    "new_resources": """
      select execution_id, coalesce(string_agg(case when from_new then address end, ',' order by i), '') as new_resources
      from (select r.execution_id, i, r.provider,
                   json_extract_string(x, '$.type')||'.'||json_extract_string(x, '$.name') as address,
                   string_split(json_extract_string(x, '$.provider'), '"')[2] = r.provider as from_new
            from {run_base} r join {state_doc} s on s.execution_id = r.execution_id
            left join lateral (select unnest(json_extract(case when s.doc = '' then '[]' else s.doc end, '$.resources[*]')) as x,
                       generate_subscripts(json_extract(case when s.doc = '' then '[]' else s.doc end, '$.resources[*]'), 1) as i) on true
            where (r.pr_id + r.cfg_key) % 4 <> 0)
      group by execution_id""",
    "dependency_edges": """
      select e.account_name as graph_id, cfg_path, dep_path,
             cast(row_number() over (partition by cfg_path order by pos) as int) as pos from {cfg_edge} e
      union all
      select account_name, cfg_path, null, -1 from {cfg_node}""",
    "new_providers": """
      select account_name as graph_id, cfg_path, case when cfg_key % 3 = 0 then '' else provider end as new_providers
      from {cfg_node}""",
    "plan_diff_dirs": """
      select commit_id, graph_id, cfg_path, error from (
        select commit_id, account_name as graph_id, null as cfg_path, 'run-all plan failed' as error
        from {run_base} where cfg_key % 29 = 0
        union all
        select commit_id, account_name, cfg_path, null from {run_base} where cfg_key % 29 <> 0 and cfg_key % 2 = 0
        union all
        select commit_id, account_name, 'shared/'||account_name, null from {run_base} where cfg_key % 29 <> 0 and cfg_key % 2 = 0)""",
    "inline_stack": """
      select r.cfg_path, cast(count(dep_path) as int) as n_deps,
             coalesce(string_agg(dep_path, '|' order by pos), '') as cfg_deps,
             cast(case when (r.pr_id + r.cfg_key) % 4 <> 0 then 1 else 0 end as int) as n_providers
      from {run_base} r left join {cfg_edge} e on e.cfg_key = r.cfg_key
      group by r.execution_id, r.cfg_path, r.pr_id, r.cfg_key""",
    "stack_append": f"""
      select commit_id, account_name, cfg_path, status, false as is_new from {{run_base}}
      union all select commit_id, graph_id, cfg_path, 'waiting', true from ({_CLOSURE})""",
    "keyed_update": """
      select r.execution_id, coalesce(u.status, r.status) as status, coalesce(u.cfg_path, r.cfg_path) as cfg_path
      from {run_base} r left join (select execution_id, max(lower(status)) as status, max(cfg_path) as cfg_path
        from {run_event} group by 1 having max(lower(status)) <> 'succeeded') u on u.execution_id = r.execution_id""",
    "constraint_check": """
      with a as (select 'run-'||l_suppkey||'-'||l_partkey as key, l_linenumber - 2 as a, l_linenumber - 1 as r,
                 l_quantity > 49 as has_star from {lineitem})
      select 'unique_key' as rule, key, count(*) as n from a group by key having count(*) > 1
      union all select 'negative_min_approval_count', key, count(*) from a where a < 0 group by key
      union all select 'negative_min_rejection_count', key, count(*) from a where r < 0 group by key
      union all select 'glob_in_account_path', key, count(*) from a where has_star group by key""",
    "config_file_filter": f"select commit_id, graph_id as account_name, dir from ({_SEEDS})",
    "pr_path_gate": f"""
      select repo, pr_id, bool_or(regexp_matches(filename, '{FILE_PATH_PATTERN}')) as matched from {{pr_file}} group by repo, pr_id""",
    "status_toggle": "select * from {commit_status} where component in ('PrPlan','Apply')",
    "webhook_route": f"select event_id, {_ROUTE} as route from ({_EVENT_FIELDS})",
    "run_event_filter": f"select event_id, status from ({_FINISHED})",
    "commit_state": """
      select execution_id, commit_id, case when status in ('failed','aborted') then 'failure' else 'success' end as state
      from {run_base}""",
    "abort_scope": """
      select execution_id from {run_base} where status in ('waiting','running') and commit_id in
        (select commit_id from {run_base} where status = 'failed')""",
    "lock_status": f"""
      select p.repo, 'feature-'||cast(p.pr_id as varchar) as head_ref,
             case when lock_value = 'none' then 'success' else 'pending' end as state,
             case when lock_value = 'none' then 'Unlocked' else 'Locked -- In Progress PR #'||lock_value end as description
      from {{build}} p join ({_LOCK}) l on l.repo = p.repo""",
    "plan_change_summary": """
      select execution_id, chr(10)||'``` diff'||chr(10)||d||chr(10)||'```'||chr(10) as diff,
             cast(%s as int) as n_add, cast(%s as int) as n_change, cast(%s as int) as n_destroy
      from (select execution_id, %s as d from {plan_text})"""
    % (_lines("[+]"), _lines("!"), _lines("-"), _MARKED),
    "signature_check": f"""
      select event_id, sig_error is null as sig_ok, sig_error from (
        select event_id, case when not starts_with(sig, 'sha256=') then 'Signature is not a valid sha256 value'
          when substr(sig, 8) <> {_hmac('body')} then 'Header signature and expected signature do not match' end as sig_error
        from (select event_id, body, {_SIGNATURE} as sig from {{webhook_body}}))""",
    "webhook_outcome": f"""
      select event_id, cast({_EVENT_CODE} as int) as status_code,
             case when route is null then 'Not Found' when sig_error is not null then sig_error
                  when number is not null and not matched then 'No diff filepath was matched within pattern: {FILE_PATH_PATTERN}'
                  when parse_error is not null then parse_error else 'Request was successful' end as message
      from ({_EVENT_CHECKED})""",
    "voter_directory": "select voter, account_name from {account_voter}",
    "account_file_join": """
      select pr_id, commit_id, filename, status, b.account_name from {changed_file} f
      join {account_base} b on starts_with(f.filename, b.account_path||'/')""",
    "stack_semi": f"""
      with diff as (select commit_id, graph_id, s.dir as cfg_path from ({_SEEDS}) s
                    join {{cfg_node}} n on n.account_name = graph_id and n.cfg_path = s.dir)
      select d.commit_id, d.graph_id, d.cfg_path, coalesce(string_agg(k.cfg_path, '|' order by e.pos), '') as cfg_deps
      from diff d left join {{cfg_edge}} e on e.cfg_path = d.cfg_path
      left join diff k on k.commit_id = d.commit_id and k.graph_id = d.graph_id and k.cfg_path = e.dep_path
      group by 1, 2, 3""",
    "cfg_blocked": _CFG_BLOCKED,
    "account_blocked": _ACCOUNT_BLOCKED,
    "reverse_deps": f"""
      select d.commit_id, d.cfg_path, c.cfg_path as dep_path from ({_CREATED}) c
      join {{cfg_edge}} e on e.cfg_key = c.cfg_key
      join ({_CREATED}) d on d.commit_id = c.commit_id and d.cfg_path = e.dep_path""",
    "rollback_guard": f"""
      select execution_id, commit_id from {{run_base}}
      where commit_id not in (select commit_id from ({_MIXED}) where mixed)""",
    "single_commit_scope": f"""
      select execution_id, commit_id, mixed as is_rollback from ({_MIXED}) where (commit_id, mixed) in
        (select (commit_id, mixed) from ({_MIXED}) where status = 'waiting')""",
    "vote_running_semi": """
      select vote_id, live_status = 'RUNNING' as accepted, case when live_status <> 'RUNNING' then
        'Approval submissions are not available anymore -- Execution Status: '||live_status end as message
      from {vote} v join {vote_run} r on r.execution_id = v.execution_id""",
    "fill_defaults": _DEFAULTS,
    "fill_dim_defaults": f"""
      select row_key, name as account_name, coalesce(given_path, name||'/'||{_hashed('k', 'path', 7)}) as account_path,
             case when row_key % 5 = 0 then segment else '' end as account_deps,
             coalesce(case when row_key % 7 = 0 then cast(row_key % 4 as int) end, {_one_or_two('k', 'approval')}) as min_approval_count,
             {_one_or_two('k', 'rejection')} as min_rejection_count,
             case when row_key % 2 = 0 then c_name||'|'||segment else '' end as voters
      from (select c_custkey as row_key, cast(c_custkey as varchar) as k, c_name, c_mktsegment as segment,
              case when c_custkey % 3 = 0 then c_name else 'account-'||{_hashed('cast(c_custkey as varchar)', 'name', 3)} end as name,
              case when c_custkey % 4 = 0 then 'live/'||c_mktsegment end as given_path from {{customer}})""",
    "abort_live_match": """
      select execution_id, case when resource_a is not null then 'live:'||execution_id end as run_ref,
             resource_a is not null as found
      from {run_base} where status = 'aborted'""",
    "next_unseen_run": """
      select commit_id, execution_id, status from (
        select *, row_number() over (partition by commit_id order by encode(execution_id)) as k from {run_base}
        where status in ('running','aborted','failed') and resource_a is null) where k = 1""",
    "voter_fanout": f"""
      select execution_id, voter, action, '{APPROVAL_URL}ses?ex='||{_link('execution_id')}||
        '&exArn='||{_link("('arn:run:*~ '||execution_id)")}||'&sm='||{_link("'arn:machine/m 1'")}||
        '&recipient='||{_link('voter')}||'&taskToken='||{_link("('tok+/='||commit_id)")}||'&action='||action||
        '&X-SES-Signature-256='||{_link("('sha256='||" + _hmac("execution_id||voter||action") + ")")} as url
      from {{run_base}} r join {{account_voter}} v on v.account_name = r.account_name
      cross join (values ('approve'), ('reject')) as x(action)
      where status = 'running'""",
    "vote_scan": f"""
      select vote_id, execution_id, case when kind <> '2' then voter end as voter,
             case when kind = '1' then 'reject' else action end as action,
             'arn:run:*~ '||execution_id as execution_arn, case when kind <> '3' then 'tok+/='||commit_id end as task_token,
             case kind when '2' then 'recipient' when '3' then 'taskToken' end as missing, {_VOTE_SIG_ERROR} as sig_error
      from ({_REQUESTS})""",
    "vote_outcome": f"""
      select vote_id, status_code, status_code = 200 as accepted, case
          when kind = '2' then 'missing: recipient' when sig_error is not null then sig_error
          when status_code = 410 then '{M.VOTE_EXPIRED}ABORTED' when kind = '3' then 'missing: taskToken'
          when status_code = 400 then '{M.UNKNOWN_RUN}' else '{M.VOTE_OK}' end as message
      from (select *, cast(case when kind = '2' then 400 when sig_error is not null then 403 when run_kind = '5' then 410
                       when kind = '3' or run_kind = '6' then 400 else 200 end as int) as status_code
            from (select *, {_VOTE_SIG_ERROR} as sig_error from ({_REQUESTS})))""",
    "plan_fanout": f"""
      select distinct repo, pr_id, b.account_name, {_CONFIG_DIR} as cfg_path, b.plan_role_arn as role_arn,
             'Plan: '||{_CONFIG_DIR} as context
      from {{pr_file}} f join {{orders}} on o_orderkey = pr_id and o_orderstatus = 'O'
      join {{account_base}} b on starts_with(f.filename, b.account_path||'/')
      where {_IS_CONFIG} and status in ('added','modified')""",
    "changed_dirs": f"""
      select distinct commit_id, {_CONFIG_DIR} as dir from {{changed_file}}
      where {_IS_CONFIG} and status <> 'renamed'""",
    "ready_ids": f"""
      select commit_id, is_rollback, cast(0 as bigint) as page, string_agg(execution_id, '|' order by encode(execution_id)) as execution_ids
      from ({_READY}) group by 1, 2""",
    "voter_union": """
      with side as (select execution_id, voter, max_by(action, (ts, vote_id)) as action from {vote} group by 1, 2),
      member as (
        select execution_id, voter, 'approve' as side from side where action = 'approve'
        union select execution_id, voter, 'reject' from side where action = 'reject'
        union select execution_id, first_approval, 'approve' from {vote_run} where first_approval is not null
          and (execution_id, first_approval) not in (select (execution_id, voter) from side where action = 'reject')
        union select execution_id, first_rejection, 'reject' from {vote_run} where first_rejection is not null
          and (execution_id, first_rejection) not in (select (execution_id, voter) from side where action = 'approve'))
      select r.execution_id,
        coalesce((select string_agg(voter, '|' order by voter) from member m where m.execution_id = r.execution_id and side = 'approve'), '') as approval_voters,
        coalesce((select string_agg(voter, '|' order by voter) from member m where m.execution_id = r.execution_id and side = 'reject'), '') as rejection_voters
      from {vote_run} r""",
    "status_rollup": """
      with s as (select l_orderkey as commit_id, l_partkey * 10 + l_linenumber as pos,
          case when l_quantity > 45 then 'aborted' when l_quantity > 40 then 'waiting'
               when l_returnflag = 'R' then 'failed' else 'succeeded' end as status from {lineitem}),
      f as (select commit_id, min(pos) filter (where status = 'waiting') as run, min(pos) filter (where status = 'aborted') as unk,
          count(*) filter (where status = 'failed') as failed from s group by 1)
      select commit_id, case when unk is not null and (run is null or unk < run) then null when run is not null then 'running'
             when failed > 0 then 'failed' else 'succeeded' end as status,
        case when unk is not null and (run is null or unk < run) then 'status is unknown: aborted' end as error
      from f""",
    "in_progress": f"""
      select repo, bool_or(status in ('waiting','running')) as in_progress from ({_REPO_RUN}) group by 1""",
    "run_counts": "select commit_id, account_name, status, count(*) as n from {run_base} group by 1, 2, 3",
    "next_pr_id": """
      select o_orderkey, cast(coalesce(given, greatest((select max(pr_id) from {run_base}), max(given) over ()) +
             sum((given is null)::int) over (order by o_orderkey rows unbounded preceding)) as int) as pr_id
      from (select o_orderkey, case when o_orderstatus = 'F' then o_custkey end as given from {orders})""",
    "next_pr_id_sequential": f"""
      with rows_given as (select o_orderkey, case when o_orderstatus = 'F' then o_orderkey % 5000 * 3 end as given from {{orders}})
      select o_orderkey, pr_id from ({_numbered_on('o_orderkey')})""",
    "delivery_failures": """
      select execution_id, failed, total, cast(case when failed > 0 then 500 else 200 end as int) as status_code,
             case when failed > 0 then failed||'/'||total||' emails failed to send' else 'All emails were successfully sent' end as message
      from (select execution_id, count(*) filter (where status <> 'Success') as failed, count(*) as total from {delivery} group by 1)""",
    "commit_paths": """
      select commit_id, cast(0 as bigint) as page, string_agg(cfg_path, '|' order by encode(cfg_path)) as cfg_paths
      from {run_base} group by 1""",
    "adjacency": """
      select n.account_name as graph_id, n.cfg_path, cast(0 as bigint) as page, coalesce(string_agg(dep_path, '|' order by pos), '') as deps
      from {cfg_node} n left join {cfg_edge} e on e.cfg_key = n.cfg_key group by 1, 2""",
    "waiting_commits_by_repo": f"""
      select repo, commit_id, is_rollback, count(*) over (partition by repo) > 1 as conflict from (
        select distinct repo, commit_id, is_rollback from ({_REPO_RUN}) where status = 'waiting' and pr_id % 4 = 0)""",
    "finished_statuses": f"""
      select event_id, json_extract_string(doc, '$.commit_id') as commit_id, json_extract_string(doc, '$.execution_id') as context,
             case when state in ('failed', 'aborted') then 'failure' else 'success' end as state, '{M.RUN_STATUS_TEXT}' as description
      from (select *, case when output is null then lower(status) else json_extract_string(output, '$.status') end as state,
              coalesce(output, input) as doc from {{run_event_doc}} where event_id in (select event_id from ({_FINISHED})))""",
    "lock_release": f"""
      select repo, 'none' as lock_value from ({_REPO_RUN}) group by 1
      having not bool_or(pr_id % 5 = 0 and status in ('waiting', 'running'))""",
    "plan_fanout_by_repo": f"""
      select distinct repo, pr_id, b.account_name, {_CONFIG_DIR} as cfg_path, b.plan_role_arn as role_arn,
             'Plan: '||{_CONFIG_DIR} as context
      from {{pr_file}} f join {{orders}} on o_orderkey = pr_id and o_orderstatus = 'O'
      join {{account_base}} b on starts_with(f.filename, b.account_path||'/') and o_custkey % 25 = b.account_key
      where {_IS_CONFIG} and status in ('added','modified')""",
    "waiting_commits": f"""
      select commit_id, is_rollback, count(*) over () > 1 as conflict from (
        select distinct commit_id, mixed as is_rollback from ({_MIXED}) where status = 'waiting')""",
    "required_status_count": """
      select commit_id, o_custkey % 6 as expected, coalesce(found, 0) as found, coalesce(finished, 0) as finished
      from (select *, md5(cast(o_orderkey as varchar)) as commit_id from {orders}) left join
        (select commit_id, count(*) as found, count(*) filter (where state <> 'pending') as finished
         from {commit_status} where context <> 'merge lock' group by 1) using (commit_id)""",
    "invocation_count": """
      select event_type as function_name, count(*) as n from {events}
      where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-20' group by 1""",
    "preceding_event": """
      select execution_id, state, status_type from (
        select *, lag(type) over (partition by execution_id order by id) as status_type from {step_event})
      where type like '%StateExited'""",
    "latest_status": """
      select commit_id, context, state, status_id from (
        select *, row_number() over (partition by commit_id, context order by ts desc, status_id desc) as k from {commit_status})
      where k = 1""",
    "latest_stream_errors": """
      select l.log_group, l.stream, l.event_id, l.message from {log_event} l join (
        select log_group, stream from (select *, row_number() over (partition by log_group order by ts desc, event_id desc) as k
        from {log_event}) where k = 1) n on n.log_group = l.log_group and n.stream = l.stream
      where contains(message, 'ERROR')""",
    "impact_closure": _CLOSURE,
    "plan_scan_diff": """
      select distinct commit_id, account_name as graph_id, cfg_path from {run_base} where cfg_key % 29 <> 0 and cfg_key % 2 = 0""",
    "deploy_stack": f"""
      with c as ({_CLOSURE}),
      teams as ({_TEAMS}),
      deps as (select c.commit_id, c.cfg_path, string_agg(e.dep_path, '|' order by e.pos) as cfg_deps
               from c join {{cfg_edge}} e on e.cfg_path = c.cfg_path
               join c k on k.commit_id = c.commit_id and k.graph_id = c.graph_id and k.cfg_path = e.dep_path group by 1, 2)
      select {_run_id('run-', 's_suppkey', 'c.commit_id', 'b.account_name', 'c.cfg_path')} as execution_id,
        false as is_rollback, cast(s_suppkey as int) as pr_id, c.commit_id, 'trunk' as base_ref,
        'feature-'||cast(s_suppkey as varchar) as head_ref, c.cfg_path, coalesce(d.cfg_deps, '') as cfg_deps, 'waiting' as status,
        'terragrunt plan --terragrunt-working-dir '||c.cfg_path||' --terragrunt-iam-role '||b.plan_role_arn||' -no-color' as plan_command,
        'terragrunt apply --terragrunt-working-dir '||c.cfg_path||' --terragrunt-iam-role '||b.apply_role_arn||' -no-color -auto-approve' as apply_command,
        case when n.cfg_key % 3 = 0 then '' else n.provider end as new_providers, b.account_name, b.account_path,
        coalesce(a.dep_name, '') as account_deps, coalesce(t.voters, '') as voters, b.min_approval_count, b.min_rejection_count
      from c join {{cfg_node}} n on n.cfg_path = c.cfg_path join {{account_base}} b on b.account_name = c.graph_id
      join {{supplier}} on md5(cast(s_suppkey as varchar)) = c.commit_id
      left join {{account_dep}} a on a.account_name = b.account_name left join teams t on t.account_name = b.account_name
      left join deps d on d.commit_id = c.commit_id and d.cfg_path = c.cfg_path""",
    "ready_frontier": _READY,
    "deploy_waves": _WAVES,
    "blocked_reasons": _REASONS,
    "cycle_members": """
      with recursive r as (
        select graph_id, cfg_path as a, dep_path as b from {loop_edge}
        union select r.graph_id, r.a, e.dep_path from r join {loop_edge} e on e.graph_id = r.graph_id and e.cfg_path = r.b)
      select graph_id, a as cfg_path, max(b) as cycle from r
      where exists (select 1 from r s where s.graph_id = r.graph_id and s.a = r.b and s.b = r.a) group by 1, 2""",
    "rollback_stack": f"""
      with created as (select * from ({_CREATED}) where commit_id in (select commit_id from {{run_base}} where status = 'failed')),
      deps as (select d.execution_id, string_agg(c.cfg_path, '|' order by encode(c.cfg_path)) as cfg_deps from created c
               join {{cfg_edge}} e on e.cfg_key = c.cfg_key
               join created d on d.commit_id = c.commit_id and d.cfg_path = e.dep_path group by 1)
      select {_run_id('run-rollback-', 'pr_id', 'commit_id', 'r.account_name', 'cfg_path')} as execution_id, true as is_rollback,
        commit_id, cfg_path, coalesce(cfg_deps, '') as cfg_deps, 'waiting' as status,
        'terragrunt plan --terragrunt-working-dir '||cfg_path||' --terragrunt-iam-role arn:plan/'||r.account_name||{_FLAGS}||' -no-color -destroy' as plan_command,
        'terragrunt destroy --terragrunt-working-dir '||cfg_path||' --terragrunt-iam-role arn:apply/'||r.account_name||{_FLAGS}||' -no-color -auto-approve' as apply_command,
        coalesce(dep_name, '') as account_deps
      from created r left join deps d on d.execution_id = r.execution_id
      left join {{account_dep}} a on a.account_name = r.account_name""",
    "target_flags": f"select execution_id, {_FLAGS} as flags from {{run_base}}",
    "webhook_stream": f"""
      with ok as (select * from ({_EVENT_CHECKED}) where {_EVENT_CODE} = 200 and matched)
      select distinct 'plan' as kind, event_id, number as pr_id, head_ref, b.account_name, {_CONFIG_DIR} as cfg_path
      from ok join {{pr_file}} f on f.repo = ok.repo and f.pr_id = number join {{account_base}} b on starts_with(f.filename, b.account_path||'/')
      where route = 'open' and {_IS_CONFIG} and f.status in ('added','modified')
      union all
      select 'stack', event_id, number, head_ref, null, null from ok where route = 'merge'""",
    "run_status_apply": f"""
      select r.execution_id, coalesce(new_status, r.status) as status from {{run_base}} r left join (
        select execution_id, max_by(new_status, (ts, encode(event_id))) as new_status from ({_FINISHED}) group by 1) e
        on e.execution_id = r.execution_id""",
    "failure_cascade": f"""
      select execution_id, case when status in ('waiting','running') and commit_id in ({_RARE_BROKEN}) then 'aborted' else status end as status,
        null as error from {{run_base}}
      union all
      select execution_id, 'failed rollback',
        'Rollback execution failed -- User with administrative privileges will need to manually fix configuration'
      from {{rare_failure}} where is_rollback and status in ('failed','aborted')""",
    "rollback_on_failure": f"""
      with created as (select * from ({_CREATED}) where commit_id in ({_RARE_BROKEN})),
      deps as (select d.execution_id, count(*) as n from created c join {{cfg_edge}} e on e.cfg_key = c.cfg_key
               join created d on d.commit_id = c.commit_id and d.cfg_path = e.dep_path group by 1),
      own as (select cfg_key, count(*) as n from {{cfg_edge}} group by 1)
      select r.execution_id, false as is_rollback,
        case when status in ('waiting','running') and commit_id in ({_RARE_BROKEN}) then 'aborted' else status end as status,
        commit_id, cfg_path, cast(coalesce(n, 0) as int) as n_deps
      from {{run_base}} r left join own on own.cfg_key = r.cfg_key
      union all
      select {_run_id('run-rollback-', 'pr_id', 'commit_id', 'r.account_name', 'cfg_path')}, true, 'waiting', commit_id, cfg_path,
        cast(coalesce(n, 0) as int) from created r left join deps d on d.execution_id = r.execution_id""",
    "advance_rollout": f"""
      with applied as (
        select r.execution_id, r.commit_id, coalesce(e.status, r.status) as status from {{run_base}} r left join (
          select execution_id, max_by(status, (ts, encode(event_id))) as status from {{rare_failure}} group by 1) e
          on e.execution_id = r.execution_id),
      cascaded as (
        select execution_id, commit_id, case when status in ('waiting','running') and commit_id in ({_RARE_BROKEN})
          then 'aborted' else status end as status from applied),
      deploy as (
        select c.*, r.cfg_key, r.cfg_path, r.account_name from cascaded c join {{run_base}} r on r.execution_id = c.execution_id),
      back as (select * from ({_CREATED}) where commit_id in ({_RARE_BROKEN}))
      select execution_id, commit_id, false as is_rollback, case when status = 'waiting'
        and not exists (select 1 from {{cfg_edge}} e join deploy p on p.cfg_path = e.dep_path
          where e.cfg_key = d.cfg_key and p.commit_id = d.commit_id and p.status <> 'succeeded')
        and not exists (select 1 from {{account_dep}} a join deploy p on p.account_name = a.dep_name
          where a.account_name = d.account_name and p.commit_id = d.commit_id and p.status <> 'succeeded')
        then 'running' else status end as status
      from deploy d
      union all
      select {_run_id('run-rollback-', 'pr_id', 'commit_id', 'b.account_name', 'cfg_path')}, commit_id, true, case when
        b.execution_id not in (select d.execution_id from back c join {{cfg_edge}} e on e.cfg_key = c.cfg_key
          join back d on d.commit_id = c.commit_id and d.cfg_path = e.dep_path)
        and (b.commit_id, b.account_name) not in (select (p.commit_id, a.account_name) from back p join {{account_dep}} a on a.dep_name = p.account_name)
        then 'running' else 'waiting' end
      from back b""",
    "vote_decision": f"""
      select execution_id, vote_id, action, cast(n_approve as bigint) as n_approve, cast(n_reject as bigint) as n_reject from ({_DECIDED})""",
    "late_votes": f"""
      select v.vote_id, d.vote_id is null or (v.ts, v.vote_id) <= (d.ts, d.vote_id) as accepted
      from {{vote}} v left join ({_DECIDED}) d on d.execution_id = v.execution_id""",
    "merge_lock": _LOCK,
    "step_outcome": """
      select execution_id,
        case scenario when 0 then 'Plan > Request Approval > Approval Results > Apply > Success'
          when 1 then 'Plan > Request Approval > Approval Results > Reject' when 2 then 'Plan > Reject'
          when 3 then 'Plan > Request Approval > Reject' else 'Plan > Request Approval > Approval Results > Apply > Reject' end as path,
        case when scenario = 0 then 'succeeded' else 'failed' end as status
      from (select 'run-'||cast(o_orderkey as varchar) as execution_id, o_orderkey % 5 as scenario from {orders})""",
    "start_ready": f"""
      select r.execution_id, to_json(struct_pack(execution_id := r.execution_id, is_rollback := r.is_rollback, pr_id := cast(pr_id as int),
        commit_id := r.commit_id, base_ref := 'trunk', head_ref := 'feature-'||cast(pr_id as varchar), cfg_path := r.cfg_path,
        cfg_deps := coalesce(deps, []::varchar[]), status := 'running', plan_command := 'plan '||r.cfg_path, apply_command := 'apply '||r.cfg_path,
        new_providers := case when (pr_id + r.cfg_key) % 4 <> 0 then [provider] else [] end,
        new_resources := list_filter([resource_a, resource_b], lambda x: x is not null),
        account_name := r.account_name, account_path := r.account_path,
        account_deps := case when dep_name is null then []::varchar[] else [dep_name] end, voters := coalesce(teams, []::varchar[]),
        approval_voters := []::varchar[], min_approval_count := b.min_approval_count, rejection_voters := []::varchar[],
        min_rejection_count := b.min_rejection_count, plan_role_arn := b.plan_role_arn, apply_role_arn := b.apply_role_arn))::varchar as input_json
      from {{run_base}} r semi join ({_READY}) k on k.execution_id = r.execution_id
      join {{account_base}} b on b.account_name = r.account_name
      left join {{account_dep}} a on a.account_name = r.account_name
      left join (select account_name, list(voter order by voter) as teams from {{account_voter}} group by 1) t on t.account_name = r.account_name
      left join (select cfg_key, list(dep_path order by pos) as deps from {{cfg_edge}} group by 1) e on e.cfg_key = r.cfg_key""",
}

ORACLES = {}


def oracle_sql() -> dict[str, str]:
    if not ORACLES:
        ORACLES.update({name: with_views(text) for name, text in _SQL.items()})
    return dict(ORACLES)
