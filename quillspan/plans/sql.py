"""SQL that produces the rows of `queries.QUERIES` by other means, for DuckDB.

Patterns are spelled for RE2: no lookaround, and classes written out where `\\s`, `\\w` or
`\\d` would only know ASCII.  Whatever is a list in the engine is unnested here where that
gives an independent formulation.
"""

from __future__ import annotations

from quillspan import fixed_values as V
from quillspan.plans import cases

ORACLE: dict[str, str] = {}

# --- fixed values: the event patterns again, in RE2's dialect ----------------------------
_S = r"\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_W = r"\p{L}\p{N}_"
_EDIT = (
    rf"sed[{_S}]+-i|tee[{_S}]+[{_W}./-]|cat[{_S}]*>|str_replace|git apply|patch[{_S}]+-p|applypatch|"
    rf"cp[{_S}]+[{_W}./-]|mv[{_S}]+[{_W}./-]|(?:^|[^-\p{{Nd}}&])>>?[{_S}]*[{_W}.]"
)
_CLAIM_WORDS = rf"pytest|python[{_S}]+-c|python3[{_S}]+-c|cargo[{_S}]+test|go[{_S}]+test|npm[{_S}]+test"
_VERIFY = rf"(?i)\b(?:{_CLAIM_WORDS}|unittest|nosetests|rake[{_S}]+test)\b"
_CLAIM = rf"(?i)\b(?:{_CLAIM_WORDS})\b"
_WIDE = (
    rf"(?i)^[{_S}]*(?:find[{_S}]+\.|find[{_S}]+/[{_S}]|grep[{_S}]+-[a-zA-Z]*r[a-zA-Z]*[{_S}]|"
    rf"rg[{_S}]+.*[{_S}]+\.|grep[{_S}]+-rn[{_S}])"
)
_INFRA = (
    rf"(?i)\b(?:pip3?[{_S}]+install\b[^\n]*\bpytest\b|python3?[{_S}]+-m[{_S}]+pip[{_S}]+install[^\n]*\bpytest\b|"
    rf"which[{_S}]+pytest|find[{_S}]+/[{_S}]+-name[{_S}]+[\"'']pytest[\"'']\b)"
)
_SUBMIT = V.SUBMIT
_FENCE = r"```(?:bash|sh|shell)?[ \t]*\n((?s:.*?))```"


def _is(pattern: str, value: str) -> str:
    return f"regexp_matches(coalesce({value}, ''), '{pattern}')"


def _strip(value: str) -> str:
    return f"regexp_replace({value}, '^[{_S}]+|[{_S}]+$', '', 'g')"


def _command(value: str) -> str:
    return _strip(f"regexp_extract(coalesce({value}, ''), '{_FENCE}', 1)")


def _why(value: str) -> str:
    return (
        f"case when {_strip(f'coalesce({value}, {chr(39) * 2})')} = '' then 'empty' "
        f"when not {_is(_FENCE, value)} then 'no bash block' else '' end"
    )


def _verify(value: str) -> str:
    return f"({_is(_VERIFY, value)} and not {_is(_SUBMIT, value)})"


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# --- trajectories ------------------------------------------------------------------------

_LEAKS = ", ".join(f"('{s}', '{i}')" for s, i in V.LEAKED_INSTANCES)
_FAMILY = f"""case when source in ({_quoted(V.PR_ONLY_SOURCES)}) then 'pr'
  when position('.' in instance_id) = 0 then 'pr'
  when starts_with(tail, 'pr_') then 'pr' when starts_with(tail, 'lm_') then 'lm'
  when starts_with(tail, 'combine') then 'combine' else 'mechanical' end"""
_LANGUAGE = f"""case when coalesce(language, '') <> '' then language
  when source in ({_quoted(V.RUST_SOURCES)}) then 'rust'
  when source in ({_quoted(V.PYTHON_SOURCES)}) then 'python' else 'mixed' end"""
_TAIL = "string_split(instance_id, '.')[-1] as tail"
_REPO = "coalesce(nullif(repo, ''), string_split(instance_id, '.')[1])"

# one row per trajectory (rid), and one per turn: pos from 1, role lower-cased, a = ordinal among assistant turns
_TRAJ = f"""
raw as (select row_number() over () as rid, * from trajectories),
kept as (select *, {_TAIL} from raw where coalesce(instance_id, '') <> ''
  and (source is null or (source, instance_id) not in ({_LEAKS}))),
turns as (
  select rid, pos, lower(coalesce(m.role, '')) as role, coalesce(m.content, '') as content
  from (select rid, unnest(messages) as m, generate_subscripts(messages, 1) as pos from raw)),
own as (select *, row_number() over (partition by rid order by pos) as a from turns where role = 'assistant'),
facts as (
  select rid, count(*) as asst,
    coalesce(min(case when {_is(_EDIT, 'content')} then a end), 0) as detected
  from own group by rid),
entries as (
  select k.rid, source, shard, row_in_shard as row, instance_id, {_REPO} as repo, {_LANGUAGE} as language,
    coalesce(nullif(family, ''), {_FAMILY}) as family, coalesce(f.asst, 0) as asst,
    coalesce(first_edit, f.detected, 0) as first_edit
  from kept k left join facts f using (rid))
"""

ORACLE["trajectory_entries"] = f"with {_TRAJ} select * exclude (rid) from entries"
ORACLE["first_edit_turn"] = f"""with {_TRAJ}
select shard, row_in_shard, coalesce(detected, 0) as detected_edit, first_edit
from raw left join facts using (rid)"""
ORACLE["assistant_counts"] = f"""with {_TRAJ}
select shard, row_in_shard, coalesce(asst, 0) as asst from raw left join facts using (rid)"""

_PICK = "(1 + position(right(sha256(instance_id), 1) in '0123456789abcdef') - 1) % 2"
_COLD = "case when (position(right(sha256(instance_id), 1) in '0123456789abcdef') - 1) % 2 = 0 then 1 else 2 end"
_TURN = {
    "cold": _COLD,
    "pre_edit": "case when first_edit <= 0 then 1 else greatest(1, first_edit - 2) end",
    "at_edit": "case when first_edit <= 0 then 1 else first_edit end",
}


def _cut_sql(phase: str) -> str:
    cap = "true" if phase == "cold" else f"coalesce(p.chars, 0) <= {V.MAX_PREFIX_CHARS}"
    return f"""
at_{phase} as (select e.*, {_TURN[phase]} as turn_idx from entries e),
edge_{phase} as (select c.rid, o.pos as stop from at_{phase} c join own o on o.rid = c.rid and o.a = c.turn_idx + 1),
p_{phase} as (
  select t.rid, sum(length(t.content)) as chars, count(*) as n_turns,
    count(*) filter (where role = 'assistant') as n_asst,
    coalesce(bool_or({_is(_EDIT, 't.content')}) filter (where role = 'assistant'), false) as edited
  from turns t join edge_{phase} g on t.rid = g.rid where t.pos < g.stop and t.content <> '' group by t.rid),
cut_{phase} as (
  select c.*, coalesce(p.chars, 0) as chars, coalesce(p.n_turns, 0) as n_turns, coalesce(p.n_asst, 0) as n_asst,
    coalesce(p.edited, false) as edited
  from at_{phase} c join edge_{phase} g using (rid) left join p_{phase} p using (rid)
  where c.asst > c.turn_idx and {cap})
"""


for _phase in V.PHASES:
    ORACLE[f"cut_{_phase}"] = f"""with {_TRAJ}, {_cut_sql(_phase)}
select shard || ':' || row || ':' || turn_idx as sample_id, '{_phase}' as phase_wanted,
  case when edited then 'at_edit' when n_asst <= 2 then 'cold' else 'pre_edit' end as phase_labeled,
  turn_idx, {V.DEFAULT_HORIZON} as horizon, source, instance_id, repo, language, family, first_edit,
  asst as asst_in_row, n_asst as asst_in_prefix, chars as prefix_chars, n_turns
from cut_{_phase}"""

ORACLE["cuttable_counts"] = f"""with {_TRAJ}, {_cut_sql('cold')}, {_cut_sql('pre_edit')}, {_cut_sql('at_edit')},
uniq as (select distinct source, shard, row from entries),
c as (select distinct source, shard, row from cut_cold),
p as (select distinct source, shard, row from cut_pre_edit where first_edit >= 4),
t as (select distinct source, shard, row from cut_at_edit where first_edit >= 1)
select u.source, count(c.shard) as n_can_cold, count(p.shard) as n_can_pre_edit, count(t.shard) as n_can_at_edit
from uniq u left join c on u.source is not distinct from c.source and u.shard = c.shard and u.row = c.row
left join p on u.source is not distinct from p.source and u.shard = p.shard and u.row = p.row
left join t on u.source is not distinct from t.source and u.shard = t.shard and u.row = t.row
group by u.source"""

_PICK_COUNT = 100  # shares are hundredths, so of a hundred picks they are the quotas
_WANTED = {name: share for name, share in (*V.OVERFIT_PHASE_SHARES, *V.OVERFIT_SOURCE_SHARES)}
_UNMET = ", ".join(
    f"case when can_{p} then {_WANTED[p]} - len(list_filter(f.s, lambda x: x.phase = '{p}')) else 0 end as d_{p}"
    for p in V.PHASES
)
_FULLEST = "greatest(d_cold, d_pre_edit, d_at_edit)"
# the serial fold: one step a candidate, the state being the list of picks
ORACLE["greedy_pick"] = f"""with recursive {_TRAJ}, {_cut_sql('cold')}, {_cut_sql('pre_edit')}, {_cut_sql('at_edit')},
able as (
  select e.source, e.shard, e.row, any_value(e.repo) as repo, bool_or(c.rid is not null) as can_cold,
    bool_or(p.rid is not null and e.first_edit >= 4) as can_pre_edit,
    bool_or(t.rid is not null and e.first_edit >= 1) as can_at_edit
  from entries e left join cut_cold c using (rid) left join cut_pre_edit p on p.rid = e.rid
  left join cut_at_edit t on t.rid = e.rid group by e.source, e.shard, e.row),
queue as (select *, row_number() over (
  order by ('0x' || substr(md5(concat_ws('|', 'quillspan', source, shard, row::varchar)), 1, 15))::bigint) as i from able),
fold as (
  select 0::bigint as i, []::struct(source varchar, shard varchar, row integer, repo varchar, phase varchar)[] as s
  union all
  select i + 1, case when taken is null then s
    else list_append(s, {{'source': source, 'shard': shard, 'row': row, 'repo': repo, 'phase': taken}}) end
  from (
    select *, case when n_source >= most or n_repo >= {dict(V.REPO_CAPS)['overfit']} or {_FULLEST} <= 0 then null
      when d_cold = {_FULLEST} then 'cold' when d_pre_edit = {_FULLEST} then 'pre_edit' else 'at_edit' end as taken
    from (
      select f.i, f.s, q.source, q.shard, q.row, q.repo, {_UNMET},
        len(list_filter(f.s, lambda x: x.source is not distinct from q.source)) as n_source,
        len(list_filter(f.s, lambda x: x.repo is not distinct from q.repo)) as n_repo,
        case {' '.join(f"when q.source = '{name}' then {_WANTED[name]}" for name in V.SOURCES)} else {_PICK_COUNT} end as most
      from fold f join queue q on q.i = f.i + 1 where len(f.s) < {_PICK_COUNT}))),
picked as (
  select unnest(s, max_depth := 2), generate_subscripts(s, 1) - 1 as pick_ord
  from (select s from fold order by i desc limit 1)),
cuts as ({' union all '.join(f"select '{p}' as phase, * from cut_{p}" for p in V.PHASES)})
select distinct c.shard || ':' || c.row || ':' || turn_idx as sample_id, c.phase as phase_wanted,
  case when edited then 'at_edit' when n_asst <= 2 then 'cold' else 'pre_edit' end as phase_labeled, turn_idx,
  case when pick_ord % 2 = 0 then {V.HORIZONS[0]} else {V.HORIZONS[1]} end as horizon, c.source, instance_id, c.repo,
  language, family, first_edit, asst as asst_in_row, n_asst as asst_in_prefix, chars as prefix_chars, pick_ord, n_turns
from picked k join cuts c on c.phase = k.phase and c.source is not distinct from k.source and c.shard = k.shard and c.row = k.row"""

ORACLE["cold_pick_parity"] = f"""select distinct instance_id, {_COLD} as pick
from trajectories where instance_id is not null"""
ORACLE["family_language"] = f"""select distinct instance_id, source, {_FAMILY} as derived_family,
  {_LANGUAGE} as own_language, {_REPO} as own_repo
from (select *, {_TAIL} from trajectories where instance_id <> '')"""
ORACLE["pool_head"] = f"""with {_TRAJ}
select * exclude (rid) from entries
order by coalesce(nullif(list_position([{_quoted(V.SOURCES)}], source), 0), 99) , source nulls first,
  shard nulls first, row nulls first, instance_id limit 100"""
ORACLE["leak_anti_join"] = """select source, count(*) as n from trajectories t where not exists (
  select 1 from prefixes p where p.split = 'test' and p.source = t.source and p.instance_id = t.instance_id)
group by source"""

# --- prefixes ----------------------------------------------------------------------------

_PRE = """pre as (select * from prefixes
  qualify row_number() over (partition by sample_id order by loaded_at desc nulls last) = 1)"""
ORACLE["prefix_phase_label"] = f"""
with raw as (select row_number() over () as rid, messages from prefixes),
turns as (select rid, unnest(messages) as m from raw),
own as (select rid, count(*) as n, bool_or({_is(_EDIT, 'm.content')}) as edited from turns
  where lower(m.role) = 'assistant' group by rid)
select case when edited then 'at_edit' when coalesce(o.n, 0) <= 2 then 'cold' else 'pre_edit' end as label,
  count(*) as n from raw left join own o using (rid) group by 1"""
ORACLE["prefix_counters"] = " union all ".join(
    f"select '{c}' as what, {c} as value, count(*) as n from prefixes group by {c}"
    for c in ("phase_wanted", "source", "family", "phase_labeled")
)
ORACLE["source_counts"] = "select source, count(*) as n from prefixes group by source"
ORACLE["phase_mismatch"] = """select count(*) as n_rows,
  count(*) filter (where phase_wanted is distinct from phase_labeled) as n_mismatch from prefixes"""
ORACLE["repo_cap"] = f"""with {_PRE} select sample_id, repo from pre
qualify row_number() over (partition by repo order by sample_id) <= 2"""
ORACLE["head_split"] = f"""with {_PRE} select sample_id,
  row_number() over (order by sample_id) <= {V.HELD_OUT_ROWS} as held_out from pre"""
ORACLE["stratified_split"] = f"""with {_PRE} select sample_id, source,
  row_number() over (partition by source order by sample_id) <= floor(count(*) over (partition by source) * 0.25)
  as held_out from pre"""
ORACLE["disjoint_train"] = f"""with {_PRE} select sample_id from pre where split = 'train' and not exists (
  select 1 from pre h where h.split in ('validation', 'test') and h.instance_id = pre.instance_id)"""
ORACLE["modulo_shard"] = f"""with {_PRE} select sample_id from (
  select sample_id, row_number() over (order by sample_id) - 1 as o from pre) where o % 4 = 1"""


def _apportion_sql(what: str, shares: tuple[tuple[str, int], ...], count: int) -> str:
    rows = ", ".join(f"({i}, '{n}', {s})" for i, (n, s) in enumerate(shares))
    return f"""select '{what}' as what, name, cast(floor(x) as bigint) + case when row_number() over (
    order by x - floor(x) desc, i) <= {count} - sum(floor(x)) over () then 1 else 0 end as want
  from (select i, name, {count}::double * s / sum(s) over () as x from (values {rows}) t(i, name, s))"""


ORACLE["apportion_quota"] = (
    _apportion_sql("phase", V.OVERFIT_PHASE_SHARES, 340)
    + " union all "
    + _apportion_sql("source", V.OVERFIT_SOURCE_SHARES, 340)
)
_HORIZON = f"coalesce(nullif(horizon, 0), {V.DEFAULT_HORIZON})"
ORACLE["expand_rollouts"] = f"""with {_PRE} select sample_id, {_HORIZON} as horizon, 6 as n_rollouts, rollout
from pre, (select unnest(range(1, 7)) as rollout)"""


def _text_literal(value: str) -> str:
    return " || chr(10) || ".join("'" + part.replace("'", "''") + "'" for part in value.split("\n"))


def _scripted_sql() -> str:
    from quillspan.operators import expand

    edit, check, search, submit = (
        _text_literal(c)
        for c in (
            V.SCRIPTED_EDIT_COMMAND,
            V.SCRIPTED_CHECK_COMMAND,
            V.SCRIPTED_SEARCH_COMMAND,
            V.SCRIPTED_SUBMIT_COMMAND,
        )
    )
    seen = "'<returncode>0</returncode>' || chr(10) || '<output>' || chr(10) || '(stub) ran: ' || c || chr(10) || '</output>'"
    return f"""with {_PRE}, base as (
  select sample_id, rollout, {_HORIZON} as h, coalesce(len(messages), 0) as n
  from pre, (select unnest([1, 2, 3, 4]) as rollout)),
steps as (select *, unnest(range(0, case when rollout % 2 = 1 then least(h, 3) else h end)) as s from base),
said as (select *, case when s = 0 then {edit} when rollout % 2 = 0 then {search}
  when s = 1 then {check} else {submit} end as c from steps)
select sample_id, rollout, case when rollout % 2 = 1 and h >= 3 then 'submit' else 'horizon' end as stopped,
  string_agg(c, chr(10) order by s) as commands,
  n + 2 * count(*) - case when rollout % 2 = 1 and h >= 3 then 1 else 0 end as n_messages,
  case when rollout % 2 = 1 and h >= 3 then {_text_literal(expand._SUBMIT_TURN)}
    else max_by({seen}, s) end as last_turn
from said group by sample_id, rollout, h, n"""


ORACLE["scripted_rollouts"] = ORACLE["policy_rollouts"] = _scripted_sql()
_ENVELOPE = f"(starts_with({_strip('t.content')}, '<tool_response>') and ends_with({_strip('t.content')}, '</tool_response>'))"
ORACLE["user_query_filter"] = f"""select coalesce(len(list_filter(messages,
  lambda t: t.role = 'user' and not {_ENVELOPE.replace('t.content', "coalesce(t.content, '''''')".replace("''''''", "''"))})), 0) > 0 as asks, count(*) as n
from prefixes group by 1"""
ORACLE["rendered_blocks"] = """select sample_id, loaded_at,
  (select count(*) from (select unnest(messages) as m, generate_subscripts(messages, 1) as i)
   where i <= 5 and (m.role in ('user', 'assistant') or (m.role = 'system' and i = 1))) as blocks
from prefixes"""

# --- rollouts ----------------------------------------------------------------------------

_SAID = f"""
raw as (select row_number() over () as rid, * from rollouts),
said as (
  select rid, i as turn_no, row_number() over (partition by rid order by i) - 1 as turn, m.content as said
  from (select rid, unnest(continuation) as m, generate_subscripts(continuation, 1) as i from raw)
  where lower(m.role) = 'assistant')
"""
ORACLE["extract_command"] = f"""with {_SAID}
select sample_id, rollout, loaded_at, turn, {_command('said')} as command, {_why('said')} as why,
  {_is(_SUBMIT, _command('said'))} as submits
from said join raw using (rid)"""
ORACLE["usable_turns"] = f"with {_SAID} select {_why('said')} as why, count(*) as n from said group by 1"

_CMDS = """cmds as (select sample_id, rollout, source, loaded_at, unnest(commands) as command,
  generate_subscripts(commands, 1) - 1 as pos from rollouts)"""
for _name, _test in {
    "submit_turns": _is(_SUBMIT, "command"),
    "edit_commands": _is(_EDIT, "command"),
    "verify_commands": _verify("command"),
    "claims_commands": _is(_CLAIM, "command"),
    "wide_search_commands": _is(_WIDE, "command"),
    "infra_commands": _is(_INFRA, "command"),
}.items():
    ORACLE[_name] = f"with {_CMDS} select sample_id, rollout, loaded_at, pos from cmds where {_test}"
ORACLE["observed_commands"] = f"""with {_CMDS} select distinct '<returncode>0</returncode>' || chr(10) || '<output>'
  || chr(10) || '(stub) ran: ' || left(replace(command, chr(10), ' '), {V.OBSERVATION_CHARS}) || chr(10) || '</output>' as seen
from cmds where command is not null"""

# commands of the continuation and of the prefix, by turn
_WORK = f"""
raw as (select row_number() over () as rid, * from rollouts),
sized as (select *, coalesce(len(messages), 0) as n, coalesce(len(continuation), 0) as k from raw),
cont_turn as (select rid, unnest(continuation) as m, generate_subscripts(continuation, 1) as i from raw),
cont as (select rid, i, {_command('m.content')} as c from cont_turn where m.role = 'assistant'),
work as (
  select rid, row_number() over (partition by rid order by i) as p, c,
    {_is(_SUBMIT, 'c')} as submits, {_is(_EDIT, 'c')} as edits, {_verify('c')} as verifies, {_is(_CLAIM, 'c')} as claims,
    {_is(_WIDE, 'c')} as wide, {_is(_INFRA, 'c')} as infra
  from cont where c <> '')
"""
_RUNS = """
steps as (select rid, c, row_number() over (partition by rid order by p) as q,
  row_number() over (partition by rid, c order by p) as r from work where {which}),
runs as (select rid, c, q - r as g, count(*) as n from steps group by rid, c, q - r),
longest as (select rid, max(n) as most from runs group by rid),
dups as (select rid, 1 - count(distinct c)::double / count(*) as dup from steps group by rid)
"""
ORACLE["longest_run"] = f"""with {_WORK}, {_RUNS.format(which='true')}
select sample_id, rollout, loaded_at, coalesce(most, 0) as longest from raw left join longest using (rid)"""
ORACLE["dup_ratio"] = f"""with {_WORK}, {_RUNS.format(which='true')}
select sample_id, rollout, loaded_at, round(dup, 6) as ratio from raw left join dups using (rid)"""

_JUDGE = f"""{_WORK}, {_RUNS.format(which='not submits')},
pre_turn as (select rid, m, i from (select rid, n, k, unnest(messages) as m, generate_subscripts(messages, 1) as i
  from sized) where n > 0 and k > 0 and i <= n - k),
pre as (select rid, bool_or({_is(_EDIT, 'c')}) as pre_edit, bool_or({_is(_CLAIM, 'c')}) as pre_claim
  from (select rid, {_command('m.content')} as c from pre_turn where m.role = 'assistant') where c <> '' group by rid),
last_edit as (select rid, max(p) as last from work where edits group by rid),
f as (
  select w.rid, any_value(l.last) as last, bool_or(submits) as submits, bool_or(verifies) as any_verify,
    coalesce(bool_or(verifies and p > l.last), false) as verified_after,
    coalesce(bool_or(claims and p < l.last), false) as claimed_before,
    bool_or(wide and p = 1) as first_wide, count(*) filter (where wide) as n_wide,
    count(*) filter (where infra) as n_infra
  from work w left join last_edit l using (rid) group by w.rid),
j as (
  select r.*, coalesce(nullif(phase_wanted, ''), 'cold') as phase, last, coalesce(submits, false) as submits,
    coalesce(claimed_before, false) or coalesce(pre_claim, false) as claimed, coalesce(first_wide, false) as first_wide,
    coalesce(n_wide, 0) as n_wide, coalesce(n_infra, 0) as n_infra,
    case when last is not null then not verified_after
      else coalesce(pre_edit, false) and coalesce(nullif(phase_wanted, ''), 'cold') = 'at_edit'
        and not coalesce(any_verify, false) end as unverified,
    case when most >= {V.MAX_RUN} then 'loop:' || most || 'x same command'
      when dup >= {V.DUP_RATIO} then 'loop:dup_ratio=' || printf('%.2f', dup) end as looped
  from raw r left join f using (rid) left join pre using (rid) left join longest using (rid) left join dups using (rid)),
judged_all as (
  select *, list_filter([
    case when starts_with(coalesce(stopped, ''), 'bad_turn') then stopped end,
    looped,
    case when phase in ('cold', 'pre_edit') and last is null then 'no_source_edit' end,
    case when phase = 'pre_edit' and first_wide then 'restart_wide_search' end,
    case when phase in ('pre_edit', 'at_edit') and n_wide >= {V.WIDE_SEARCH_LIMIT} then 'search_spam' end,
    case when n_infra >= {V.INFRA_LIMIT} then 'infra_thrash' end,
    case when unverified then 'no_verify_after_edit' end,
    case when last is not null and phase = 'cold' and not claimed then 'edit_before_repro' end,
    case when submits and unverified then 'submit_without_verify' end], lambda x: x is not null) as reasons
  from j),
judged as (select *, len(reasons) = 0 as keep from judged_all
  qualify row_number() over (partition by sample_id, rollout order by loaded_at desc nulls last) = 1)
"""
ORACLE["judge_reasons"] = f"""with {_JUDGE} select sample_id, rollout, loaded_at, len(reasons) = 0 as keep,
  coalesce(array_to_string(reasons, '|'), '') as reasons from judged_all"""
ORACLE["keep_drop"] = f"""with {_JUDGE} select count(*) filter (where keep) as n_keep,
  count(*) filter (where not keep) as n_drop from judged"""
ORACLE["reason_counts"] = f"""with {_JUDGE} select reason, count(*) as n
from (select unnest(reasons) as reason from judged where not keep) group by reason"""
_PREFIX_SIZE = """case when coalesce(len(messages), 0) > 0 and coalesce(len(continuation), 0) > 0
  then greatest(len(messages) - len(continuation), 0) else 0 end"""
ORACLE["sft_rows"] = f"""with {_JUDGE} select 'sft' as kind, sample_id, phase_wanted, {_PREFIX_SIZE} as n_prefix,
  len(messages) as n_messages from judged where keep"""
ORACLE["dpo_pairs"] = f"""with {_JUDGE},
ranked as (select *, row_number() over (partition by sample_id, keep order by rollout) as k from judged)
select 'dpo' as kind, a.sample_id, a.phase_wanted, a.rollout as chosen_rollout, b.rollout as rejected_rollout,
  coalesce(array_to_string(b.reasons, '|'), '') as rejected_reasons,
  case when coalesce(len(a.messages), 0) > 0 and coalesce(len(a.continuation), 0) > 0
    then greatest(len(a.messages) - len(a.continuation), 0) else 0 end as n_prompt,
  coalesce(len(a.continuation), 0) as n_chosen, coalesce(len(b.continuation), 0) as n_rejected
from ranked a join ranked b on a.sample_id = b.sample_id and a.k = b.k and a.keep and not b.keep"""
_PER = """per as (select sample_id, count(*) filter (where keep) as keeps, count(*) filter (where not keep) as drops
  from judged group by sample_id)"""
ORACLE["unpaired_keeps"] = f"""with {_JUDGE}, {_PER} select cast(sum(keeps) as bigint) as n_keep,
  cast(sum(least(keeps, drops)) as bigint) as n_pair,
  cast(sum(keeps - least(keeps, drops)) as bigint) as n_unpaired from per"""
_STATE = "case when drops = 0 then 'all_keep' when keeps = 0 then 'all_drop' else 'both' end"
ORACLE["ready_tickets"] = f"with {_JUDGE}, {_PER} select sample_id, keeps, drops, {_STATE} as state from per"
ORACLE["readiness"] = f"""with {_JUDGE}, {_PER}, s as (select *, {_STATE} as state from per)
select cast(sum(keeps) as bigint) as n_keep, count(*) filter (where state = 'both') as n_both,
  count(*) filter (where state = 'all_keep') as n_all_keep, count(*) filter (where state = 'all_drop') as n_all_drop,
  sum(keeps) >= {V.KEEP_BAR} and count(*) filter (where state = 'both') >= {V.TICKET_BAR} as ready from s"""
ORACLE["meter_rates"] = f"""with {_JUDGE},
each as (
  select rid, bool_or({_is(_EDIT, 'c')}) as edit, bool_or({_verify('c')}) as verify
  from (select rid, unnest(commands) as c from judged) group by rid),
m as (
  select phase, coalesce(edit, false) as edit, coalesce(verify, false) as verify,
    not list_contains(reasons, 'no_verify_after_edit') as fine,
    len(list_filter(reasons, lambda r: starts_with(r, 'loop:'))) > 0 as looping,
    coalesce(commands[1], '') <> '' and not {_is(_WIDE, 'commands[1]')} as focused
  from judged left join each using (rid))
select count(*) filter (where phase = 'cold') as n_cold, count(*) filter (where phase = 'pre_edit') as n_pre_edit,
  count(*) as n_all,
  round(avg(case when phase = 'cold' then (fine and verify)::int end), 9) as cold_verify_rate,
  round(avg(case when phase = 'cold' then edit::int end), 9) as cold_edit_rate,
  round(avg(case when phase = 'pre_edit' then focused::int end), 9) as pre_edit_no_wide,
  round(avg(case when phase = 'pre_edit' then edit::int end), 9) as pre_edit_edit_rate,
  round(avg(looping::int), 9) as loop_rate,
  round(avg(case when phase = 'at_edit' then verify::int end), 9) as at_edit_verify_rate
from m"""
ORACLE["phase_counts"] = f"with {_JUDGE} select phase, count(*) as n from judged group by phase"

_BLOCK = "(m.role in ('user', 'assistant') or (m.role = 'system' and i = 1))"
_SPANS = f"""
raw as (select row_number() over () as rid, *, {_PREFIX_SIZE} as n_prefix from rollouts),
t as (select rid, n_prefix, unnest(messages) as m, generate_subscripts(messages, 1) as i from raw),
b as (select rid, n_prefix, i, m.role as role, coalesce(m.content, '') as content,
  length(m.role) + length(coalesce(m.content, '')) + 24 as size from t where {_BLOCK}),
rendered as (
  select rid, sum(size) as chars,
    sum(size) filter (where i <= n_prefix) as cut,
    sum(size) filter (where i > n_prefix and role = 'assistant') as learned
  from b group by rid)
"""
ORACLE["span_mask"] = f"""with {_SPANS} select sample_id, rollout, loaded_at, cast(coalesce(chars, 0) as int) as chars,
  cast(coalesce(cut, 0) as int) as cut, cast(coalesce(learned, 0) as int) as learned from raw left join rendered using (rid)"""
def _words(most: int) -> str:
    return f"""{_SPANS},
words as (
  select rid, n_prefix, i, role, len(regexp_extract_all('<|im_start|>' || role || chr(10) || content || '<|im_end|>', '[^{_S}]+')) as n
  from b),
placed as (select *, sum(n) over (partition by rid order by i) as upto from words),
tok as (
  select rid, least(sum(n), {most}) as n, sum(n) as whole,
    sum(case when i > n_prefix and role = 'assistant' then greatest(0, n - greatest(0, upto - {most})) else 0 end) as learned,
    sum(case when i > n_prefix and role = 'assistant' then n else 0 end) as all_learned
  from placed group by rid),
asked as (select distinct rid from t where m.role = 'user' and not {_ENVELOPE.replace('t.content', "coalesce(m.content, '')")}),
ex as (select raw.sample_id, raw.rollout, raw.loaded_at, tok.n, tok.learned from raw join tok using (rid)
  join asked using (rid) where whole >= 2 and all_learned > 0)
"""


for _name, _most in (("", 512), ("_long", 8192)):
    ORACLE[f"sft_tokens{_name}"] = f"""with {_words(_most)} select sample_id, rollout, loaded_at, cast(n as int) as n,
  cast(learned as int) as learned from ex"""
    ORACLE[f"pad_batch{_name}"] = f"""with {_words(_most)} select sample_id, cast(max(n) as int) as shortest,
  cast(max(n) as int) as longest, cast(sum((select max(n) from ex e2 where e2.sample_id = ex.sample_id) - n) as bigint) as pads
  from ex group by sample_id"""
ORACLE["pad_rows"] = f"""with {_words(8192)}, numbered as (
  select n, (row_number() over (order by sample_id nulls first, rollout nulls first, loaded_at nulls first) - 1) // 8 as batch from ex)
select batch, count(*) as rows, cast(max(n) as int) as shortest, cast(max(n) as int) as longest,
  cast(sum(most - n) as bigint) as pads
from (select *, max(n) over (partition by batch) as most from numbered) group by batch"""
ORACLE["skipped_examples"] = f"""with {_words(8192)} select (select count(*) from raw) as n_rows,
  (select count(*) from ex) as n_examples, (select count(*) from raw) - (select count(*) from ex) as n_skipped"""
ORACLE["dpo_usable"] = """select len(prompt) as n_prompt, len(chosen) as n_chosen, len(rejected) as n_rejected
from dpo where len(prompt) > 0 and len(chosen) > 0 and len(rejected) > 0"""


# --- built-in cases and files --------------------------------------------------------------


def _literal(value) -> str:
    if value is None:
        return "null"
    return str(value) if isinstance(value, int) else _text_literal(value)


_CASES = ", ".join(f"({i}, {_literal(c)})" for i, c in enumerate(cases.COMMANDS))
ORACLE["detector_cases"] = f"""select id, {_is(_EDIT, 'c')} as edit, {_verify('c')} as verify, {_is(_CLAIM, 'c')} as claim,
  {_is(_WIDE, 'c')} as wide, {_is(_INFRA, 'c')} as infra, {_is(_SUBMIT, 'c')} as submit
from (select id, coalesce(c, '') as c from (values {_CASES}) t(id, c))"""


def _turn_literal(turns) -> str:
    inner = ", ".join(f"{{'role': {_literal(r)}, 'content': {_literal(c)}}}" for r, c in turns)
    return f"[{inner}]::struct(role varchar, content varchar)[]"


_ROLLED = " union all ".join(
    f"select {_literal(r.sample_id)} as sample_id, {r.rollout} as rollout, {_literal(r.phase_wanted)}::varchar as phase_wanted, "
    f"{_literal(r.stopped)}::varchar as stopped, {_turn_literal(r.messages)} as messages, {_turn_literal(r.continuation)} as continuation, "
    f"[{', '.join(map(_literal, r.commands))}]::varchar[] as commands, null::timestamp as loaded_at"
    for r in cases.ROLLOUTS
)
ORACLE["rule_cases"] = f"""with rollouts as ({_ROLLED}), {_JUDGE.lstrip()} select sample_id, rollout, keep,
  coalesce(array_to_string(reasons, '|'), '') as reasons from judged"""
ORACLE["jsonl_round_trip"] = """select sample_id, phase_wanted, phase_labeled, turn_idx, horizon, source, instance_id, repo,
  language, family, first_edit, prefix_chars, len(messages) as n_turns,
  md5(array_to_string(list_transform(messages, lambda m: coalesce(m.role, '-') || ':' || coalesce(m.content, '-')), '|')) as said
from prefixes"""
ORACLE["split_round_trip"] = f"""with {_JUDGE} select sample_id, rollout, keep, len(reasons) as n_reasons,
  len(messages) as n_messages from judged"""
ORACLE["pool_round_trip"] = f"""select source, count(*) as n, sum(len(messages)) as n_turns,
  count(distinct instance_id) as n_instances from trajectories where source in ({_quoted(V.SOURCES)}) group by source"""
