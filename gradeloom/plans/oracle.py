"""SQL twins of the registered queries, for a second engine to run on the same Parquet tables."""

from __future__ import annotations

from gradeloom.functions.answers import GOLD_FORMS
from gradeloom.functions.patterns import (
    ANSWER_PATTERNS,
    ANSWER_PROFILES,
    GOLD_ANNOTATION,
    GOLD_MARKER,
    NO_ANSWER,
    NUMBER,
)
from gradeloom.functions.prompts import TEMPLATES
from gradeloom.plans.catalog import CONFIGS, MAX_NEW_TOKENS, SYSTEM_PROMPT

_SPACES = (
    r"\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def _regex(pattern: str, flags: str = "") -> str:
    """RE2 spelling: its own ``\\s`` and ``\\d`` are ASCII only."""
    spelled = pattern.replace(r"\s", f"[{_SPACES}]").replace(r"\d", r"\p{Nd}")
    return f"'{f'(?{flags})' if flags else ''}{spelled}'"


def _lit(text: str) -> str:
    """A string literal, line breaks spelled as chr(10)."""
    return "(" + " || chr(10) || ".join("'" + part.replace("'", "''") + "'" for part in text.split("\n")) + ")"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{_SPACES}]+|[{_SPACES}]+$', '', 'g')"


def _answer(x: str, profile: str) -> str:
    arms = []
    for name in ANSWER_PROFILES[profile]:
        regex = _regex(ANSWER_PATTERNS[name], "im")
        arms.append(f"when regexp_matches({x}, {regex}) then regexp_extract({x}, {regex}, 1)")
    return (
        f"case {' '.join(arms)} else coalesce(list_extract(regexp_extract_all({x}, {_regex(NUMBER)}), -1), "
        f"'{NO_ANSWER[profile]}') end"
    )


def _gold(x: str, profile: str) -> str:
    marker = _regex(GOLD_MARKER)
    fallbacks = [f"list_extract(regexp_extract_all({x}, {_regex(NUMBER)}), -1)", x if profile == "compare" else _strip(x)]
    if profile == "calc":
        fallbacks.insert(0, f"list_extract(regexp_extract_all({x}, {_regex(GOLD_ANNOTATION)}, 1), -1)")
    return (
        f"case when regexp_matches({x}, {marker}) then regexp_extract({x}, {marker}, 1) "
        f"else coalesce({', '.join(fallbacks)}) end"
    )


def _number(x: str) -> str:
    digits = "[0-9](?:_?[0-9])*"
    regex = rf"'[+-]?(?:{digits}(?:\.(?:{digits})?)?|\.{digits})(?:[eE][+-]?{digits})?'"
    return f"case when regexp_full_match({_strip(x)}, {regex}) then try_cast(replace({_strip(x)}, '_', '') as double) end"


def _grade(predicted: str, gold: str, fold: str = "") -> str:
    a, b = _number(predicted), _number(gold)
    return (
        f"case when ({a}) is not null and ({b}) is not null then abs(({a}) - ({b})) < 0.001 "
        f"else {fold}({_strip(predicted)}) = {fold}({_strip(gold)}) end"
    )


def _prompt(question: str, name: str) -> str:
    t = TEMPLATES[name]
    return f"({_lit(t.prefix)} || {question} || {_lit(t.suffix)})"


_TOTAL = "cast(o_custkey % 97 + o_orderkey % 13 as varchar)"

_QA = f"""qa as (select o_orderkey as sample_idx,
 'Order ' || cast(o_orderkey as varchar) || ': what is ' || cast(o_custkey % 97 as varchar) || ' plus '
   || cast(o_orderkey % 13 as varchar) || '?' as question,
 case when o_orderkey % 8 <= 3 then 'It has <<' || cast(o_custkey % 97 as varchar) || '+'
     || cast(o_orderkey % 13 as varchar) || '=' || {_TOTAL} || '>> items.' || chr(10) || '#### ' || {_TOTAL}
  when o_orderkey % 8 = 4 then 'It has <<1+2=' || {_TOTAL} || '>> items in 2 days'
  when o_orderkey % 8 = 5 then 'A total of ' || {_TOTAL} || ' items'
  when o_orderkey % 8 = 6 then '  no digits here' || chr(10)
  else '#### ' || case when o_custkey % 2 = 0 then '-' else '1,' end || {_TOTAL} end as answer
 from orders)"""

_RESPONSES = f"""responses as (select o_orderkey as sample_idx, cast(gen as integer) as gen, cast(gen as integer) as run_id,
 case gen % 3 when 0 then 'no_system' when 1 then 'standard' else 'cot' end as config,
 case (o_orderkey * 7 + gen) % 9
  when 0 then 'We get ' || chr(92) || 'boxed{{' || p || '}}'
  when 1 then 'boxed{{ ' || p || ' }} done'
  when 2 then 'The Answer: ' || p || '.5 and 9'
  when 3 then 'first 4' || chr(10) || 'therefore, the answer is ' || p || ' ok'
  when 4 then 'x = ' || p || chr(10) || 'the end'
  when 5 then p || ' is the answer, not 3'
  when 6 then 'got 3 and then ' || p || ' stop.'
  when 7 then 'I do not know'
  else chr(92) || 'boxed{{' || chr(92) || 'frac{{' || p || '}}{{2}}}}' end as response,
 cast(100 + (o_orderkey * 13 + gen * 7) % 1950 as integer) as input_tokens,
 cast(20 + (o_orderkey * 31 + gen * 17) % 237 as integer) as output_tokens
 from (select *, {_TOTAL} as p from orders) o, unnest([0, 1, 2, 3]) as g(gen))"""

_GRADED = f"""{_QA}, {_RESPONSES},
extracted as (select r.*, q.question, q.answer as ground_truth_raw, {_gold('q.answer', 'basic')} as ground_truth,
  {_answer('r.response', 'full')} as predicted from responses r join qa q using (sample_idx)),
graded as (select *, {_grade('predicted', 'ground_truth')} as correct, output_tokens >= {MAX_NEW_TOKENS} as truncated,
  cast({_grade('predicted', 'ground_truth')} as integer)::double as reward from extracted)"""

_FLAWED = f"""{_QA}, {_RESPONSES},
flawed as (select * replace (case when sample_idx % 11 = 0 then '' else response end as response,
  case when sample_idx % 7 <> 0 then gen % 2 end as run_id) from responses),
delivered as (select * from flawed union all select * from flawed where sample_idx % 13 = 0),
gold as (select sample_idx, question, case when sample_idx % 19 = 0 then '' else answer end as answer from qa where sample_idx % 17 <> 0),
extracted as (select r.*, q.question, q.answer as ground_truth_raw, {_gold('q.answer', 'basic')} as ground_truth,
  {_answer('r.response', 'full')} as predicted from delivered r left join gold q using (sample_idx)),
graded as (select *, ground_truth_raw is not null and coalesce({_grade('predicted', 'ground_truth')}, false) as correct from extracted)"""

_SAMPLES = """samples as (select case when user_id % 2 = 0 then 'G2_B2' else 'G4_B4' end as config, ts,
 value * 1024 / 64 as used_mb from events)"""

_RUNS = """runs as (select o_custkey as run_id, o_orderkey as step, cast(o_orderkey % 5 as integer) as exit_code,
 o_totalprice / 100000 as elapsed_s, cast(o_orderkey % 4 as integer) as n_samples,
 'G' || cast(o_orderkey % 4 + 1 as varchar) || '_B' || cast((o_custkey % 6 + 1) * 2 as varchar) as config from orders),
parsed as (select *, cast(regexp_extract(config, '^G([0-9]+)_B([0-9]+)$', 1) as integer) as num_generations,
 cast(regexp_extract(config, '^G([0-9]+)_B([0-9]+)$', 2) as integer) as batch_size from runs),
sweep as (select * from parsed where batch_size % num_generations = 0)"""

_LOGPS = """logps as (select l_suppkey % 5 as run_id, -l_quantity / 10 as chosen, -l_extendedprice / 10000 as rejected,
 -l_discount * 10 as ref_chosen, -l_tax * 10 as ref_rejected from lineitem)"""

_MESSAGES = (
    f"cast(2 as integer) as n_messages, 'system' as role_0, {_lit(SYSTEM_PROMPT)} as content_0, 'user' as role_1, "
    "question as content_1"
)

_SPLIT = "case when sample_idx % 10 = 0 then 'test' else 'train' end"


def _coverage(profile: str, text: str, source: str) -> str:
    names = ANSWER_PROFILES[profile]
    hits = ", ".join(f"regexp_matches({text}, {_regex(ANSWER_PATTERNS[n], 'im')}) as h{i}" for i, n in enumerate(names))
    rows = []
    for i, name in enumerate(names):
        earlier = "".join(f" and not h{j}" for j in range(i))
        rows.append(
            f"select '{name}' as pattern, count(*) filter (where h{i}) as matched, "
            f"count(*) filter (where h{i}{earlier}) as first_hit, count(*) as total from hits"
        )
    return f"""hits as (select {hits} from {source}), counted as ({' union all '.join(rows)})
select pattern, matched, first_hit, round(matched * 100.0::double / total, 6) as matched_pct,
 round(first_hit * 100.0::double / total, 6) as first_hit_pct from counted"""


_READ_QA = f"with {_QA} select {_SPLIT} as split, question, answer from qa"
_PREVIEWS = ", ".join(
    f"case when length(text) > {n} then substring(text, 1, {n}) || '...' else text end as first_{n}"
    for n in (80, 100, 150, 200, 500, 1000)
)
_CONFIG_ROWS = " union all ".join(
    f"select sample_idx, '{c}' as config, {_prompt('question', c)} as prompt from qa" for c in CONFIGS
)
_SYSTEM_ROWS = " union all ".join(
    f"select sample_idx, '{name}' as config, {_lit(t.system) if t.system else 'cast(null as varchar)'} as system_prompt from qa"
    for name, t in TEMPLATES.items()
)
_ACCURACY = "round(correct_count * 100.0::double / {n}, 6) as accuracy"
_BATCHED = f"batched as (select *, sample_idx // 32 as batch_id, cast(sample_idx % 32 as integer) as batch_pos from responses)"
_BEST_WORST = """ends as (select sample_idx, count(*) as group_size,
 first(gen order by reward desc, gen) as best_gen, first(reward order by reward desc, gen) as best_reward,
 first(response order by reward desc, gen) as best_response, last(gen order by reward desc, gen) as worst_gen,
 last(reward order by reward desc, gen) as worst_reward, last(response order by reward desc, gen) as worst_response
 from graded group by sample_idx)"""
_SIDE = ", ".join(
    f"arg_min(predicted, gen) filter (where config = '{c}') as {c}_predicted, "
    f"arg_min(correct, gen) filter (where config = '{c}') as {c}_correct, "
    f"arg_min(response, gen) filter (where config = '{c}') as {c}_response, "
    f"arg_min(output_tokens, gen) filter (where config = '{c}') as {c}_output_tokens"
    for c in CONFIGS
)

_SIGNED = r"-?(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)"
_LENGTHS = ", ".join(
    f"min(length({c})) as {c}_min_chars, round(avg(length({c})), 6) as {c}_avg_chars, max(length({c})) as {c}_max_chars"
    for c in ("question", "answer")
)
_FORM = (
    f"case when regexp_matches(answer, {_regex(GOLD_MARKER)}) then 'marker' when regexp_matches(answer, {_regex(GOLD_ANNOTATION)}) "
    "then 'annotation' when regexp_matches(answer, '[0-9]') then 'number' else 'text' end"
)
_FORMS = ", ".join(
    f"round(count(*) filter (where {_FORM} = '{form}') * 100.0::double / count(*), 6) as gold_{form}_pct" for form in GOLD_FORMS
)

ORACLE_SQL: dict[str, str] = {
    "read_qa": _READ_QA,
    "read_qa_json": _READ_QA,
    "read_qa_arrow": _READ_QA,
    "resolve_qa_columns": f"with {_QA} select sample_idx, question, answer from qa",
    "write_training_jsonl": f"with {_QA} select {_MESSAGES}, {_gold('answer', 'basic')} as solution from qa",
    "write_training_jsonl_single": f"with {_QA} select {_MESSAGES}, {_gold('answer', 'basic')} as solution from qa",
    "write_eval_results": f"""with {_GRADED}, per_run as (select run_id, count(*) as n, count(*) filter (where correct) as
 correct_count from graded group by run_id), memory as (select user_id % 7 as run_id, max(value / 32) as peak from events group by 1)
select g.run_id, config, sample_idx, gen, question, ground_truth_raw, ground_truth, predicted, response, correct, input_tokens,
 output_tokens, truncated, round(correct_count * 100.0::double / n, 6) as run_accuracy, round(peak, 6) as run_peak_reserved_gb,
 cast(32 as integer) as run_batch_size
from graded g join per_run p on g.run_id = p.run_id join memory m on g.run_id = m.run_id""",
    "limit_samples": f"with {_QA} select * from qa order by sample_idx limit 1000",
    "format_prompt": f"with {_QA} select sample_idx, {', '.join(_prompt('question', n) + ' as ' + n for n in TEMPLATES)} from qa",
    "render_chat": "select conv_id, turn, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) || "
    "'<|im_start|>assistant' || chr(10) as prompt from conversations",
    "extract_system_prompt": f"with {_QA} {_SYSTEM_ROWS}",
    "preview_text": f"select doc_id, {_PREVIEWS} from documents",
    "sample_preview": f"with {_QA} select sample_idx, "
    + ", ".join(f"case when length({c}) > 20 then substring({c}, 1, 20) || '...' else {c} end as {c}" for c in ("question", "answer"))
    + " from qa order by sample_idx limit 5",
    "incorrect_samples": f"""with {_GRADED} select run_id, sample_idx, question, ground_truth, predicted, correct, truncated
from graded where not correct or truncated""",
    "sweep_filter": f"with {_RUNS} select run_id, step, config, num_generations, batch_size from sweep",
    "extract_answer": f"with {_RESPONSES} select sample_idx, gen, "
    + ", ".join(f"{_answer('response', p)} as {p}" for p in ("full", "full8", "plain", "compare"))
    + " from responses",
    "extract_answer_documents": "select doc_id, "
    + ", ".join(f"{_answer('text', p)} as {p}" for p in ("full", "plain", "compare"))
    + " from documents",
    "extract_gold": f"with {_QA} select sample_idx, {_gold('answer', 'basic')} as gold from qa",
    "extract_gold_calc": f"with {_QA} select sample_idx, {_gold('answer', 'calc')} as gold from qa",
    "extract_gold_compare": f"with {_QA} select sample_idx, {_gold('answer', 'compare')} as gold from qa",
    "extract_gold_strict": f"""with {_QA}, m as (select *, regexp_extract(answer, '#### *({_SIGNED})', 1) as marked from qa)
select sample_idx, case when marked <> '' then replace(marked, ',', '')
 else coalesce(list_extract(regexp_extract_all(answer, {_regex(NUMBER)}), -1), {_strip('answer')}) end as gold from m""",
    "grade_answer": f"with {_GRADED} select sample_idx, gen, predicted, ground_truth, correct from graded",
    "grade_answer_ci": f"""select o_orderkey,
 {_grade("(' ' || upper(o_orderpriority))", "o_orderpriority", "lower")} as nocase,
 {_grade("(' ' || upper(o_orderpriority))", "o_orderpriority")} as exact,
 {_grade("(' ' || cast(o_custkey % 3 as varchar) || 'e0 ')", "cast(o_orderkey % 3 as varchar)", "lower")} as numeric
from orders""",
    "strip_prompt_echo": f"""with {_GRADED} select sample_idx, gen,
 case when gen % 2 = 0 then {_strip('response')} else response end as reply from graded""",
    "flag_truncated": f"""with {_RESPONSES} select run_id, sample_idx, input_tokens, output_tokens,
 output_tokens >= {MAX_NEW_TOKENS} as truncated from responses""",
    "flag_truncated_batch_padded": f"""with {_RESPONSES}, {_BATCHED}, padded as (select run_id, sample_idx, batch_id, batch_pos,
 max(input_tokens) over (partition by run_id, batch_id) as input_tokens,
 max(output_tokens) over (partition by run_id, batch_id) as output_tokens from batched)
select *, output_tokens >= {MAX_NEW_TOKENS} as truncated from padded""",
    "flag_long_input": f"with {_RESPONSES} select run_id, sample_idx, input_tokens, input_tokens > 1900 as long_input from responses",
    "build_messages": f"with {_QA} select sample_idx, {_MESSAGES} from qa",
    "reward_accuracy": f"with {_GRADED} select sample_idx, gen, reward from graded",
    "reward_registry": f"""with {_GRADED} select sample_idx, gen,
 round(reward + 0.25::double * (case when truncated then 0 else 1 end), 6) as reward from graded""",
    "reward_registry_python": f"""with {_GRADED} select sample_idx, gen, round(reward + 0.5::double / output_tokens
 + 0.25::double * (length(response) - length(replace(response, chr(10), ''))), 6) as reward from graded""",
    "sft_nll": f"with {_LOGPS} select run_id, round(avg(-chosen), 6) as loss from logps group by run_id",
    "dpo_loss": f"""with {_LOGPS} select run_id, round(avg(ln(1 + exp(-0.1::double * (chosen - rejected)))), 6) as loss,
 round(avg(case when chosen > rejected then 1.0::double else 0 end), 6) as preference_accuracy from logps group by run_id""",
    "dpo_loss_reference": f"""with {_LOGPS}, m as (select run_id, chosen - rejected - (ref_chosen - ref_rejected) as margin from logps)
select run_id, round(avg(ln(1 + exp(-0.1::double * margin))), 6) as loss,
 round(avg(case when margin > 0 then 1.0::double else 0 end), 6) as preference_accuracy from m group by run_id""",
    "expand_configs": f"with {_QA} {_CONFIG_ROWS}",
    "expand_configs_table": f"""with {_QA} select sample_idx, r_name as config, 'Region ' || r_regionkey || ': ' || question
 || case when r_regionkey > 0 then chr(10) || r_name else '' end as prompt from qa cross join region""",
    "join_gold": f"with {_QA}, {_RESPONSES} select sample_idx, gen, question, answer, response from responses join qa using (sample_idx)",
    "compare_side_by_side": f"with {_GRADED} select sample_idx, max(question) as question, max(ground_truth) as ground_truth, {_SIDE} from graded group by sample_idx",
    "compare_runs": f"""with {_GRADED}, paired as (select a.correct as a, b.correct as b from graded a join graded b
 on a.sample_idx = b.sample_idx and a.gen // 2 = b.gen // 2 and a.gen % 2 = 0 and b.gen % 2 = 1)
select count(*) as n_samples, count(*) filter (where a) as correct_a, count(*) filter (where b) as correct_b,
 count(*) filter (where not a and b) as fixed, count(*) filter (where a and not b) as broken,
 count(*) filter (where a and b) as both, count(*) filter (where not a and not b) as neither,
 round(count(*) filter (where a) * 100.0::double / count(*), 6) as accuracy_a,
 round(count(*) filter (where b) * 100.0::double / count(*), 6) as accuracy_b,
 round((count(*) filter (where b) - count(*) filter (where a)) * 100.0::double / count(*), 6) as lift from paired""",
    "eval_summary": f"""with {_GRADED}, per_run as (select run_id, count(*) as total_samples,
 count(*) filter (where correct) as correct_count, count(*) filter (where truncated) as truncated_count from graded group by run_id),
times as (select cast(o_orderkey % 4 as integer) as run_id, sum(o_totalprice / 100000) as seconds from orders group by 1)
select run_id, total_samples, correct_count, total_samples - correct_count as incorrect_count, truncated_count,
 {_ACCURACY.format(n='total_samples')}, round(seconds, 3) as inference_time_seconds,
 round(seconds / total_samples, 6) as avg_time_per_sample from per_run join times using (run_id)""",
    "accuracy_by_config": f"""with {_GRADED}, c as (select config, count(*) filter (where correct) as correct_count,
 count(*) as total from graded group by config) select config, correct_count, total, {_ACCURACY.format(n='total')} from c""",
    "pattern_coverage": f"with {_RESPONSES}, {_coverage('full8', 'response', 'responses')}",
    "pattern_coverage_documents": f"with {_coverage('full', 'text', 'documents')}",
    "truncation_report": f"""with {_RESPONSES}, c as (select run_id, count(*) as total_samples,
 count(*) filter (where output_tokens >= {MAX_NEW_TOKENS}) as truncated_count from responses group by run_id)
select *, round(truncated_count * 100.0::double / total_samples, 6) as truncated_pct,
 truncated_count > 0 as raise_token_budget from c""",
    "audit_samples": f"""with {_GRADED}, issues as (select 'no_system_prompt' as issue from graded where config = 'no_system'
 union all select 'input_near_limit' from graded where input_tokens > 1900
 union all select 'answer_mismatch' from graded where not correct)
select issue, count(*) as n_rows from issues group by issue""",
    "audit_rows": f"""with {_FLAWED}, issues as (select 'empty_question' as issue from graded where coalesce(question, '') = ''
 union all select 'empty_response' from graded where coalesce(response, '') = ''
 union all select 'no_gold' from graded where ground_truth_raw is null
 union all select 'empty_gold' from graded where ground_truth_raw = ''
 union all select 'no_answer' from graded where predicted = '无法提取答案'
 union all select 'duplicate_key' from graded qualify row_number() over (partition by run_id, gen, sample_idx) > 1)
select issue, count(*) as n_rows from issues group by issue""",
    "running_accuracy_flawed": f"""with {_FLAWED}, c as (select run_id, sample_idx, count(*) as n, count(*) filter (where correct) as k
 from graded group by all), s as (select run_id, sample_idx, cast(sum(n) over w as bigint) as seen, cast(sum(k) over w as bigint) as correct_so_far
 from c window w as (partition by run_id order by sample_idx))
select *, round(correct_so_far * 100.0::double / seen, 6) as accuracy from s""",
    "dataset_profile": f"""with {_QA} select {_SPLIT} as split, count(*) as n_rows, 'sample_idx,question,answer' as columns,
 {_LENGTHS}, {_FORMS} from qa group by 1""",
    "resource_summary": f"""with {_SAMPLES} select config, round(max(used_mb / 1024), 6) as max_gb, round(avg(used_mb / 1024), 6) as avg_gb,
 count(*) as n_samples, round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::double, 3) as duration_s from samples group by config""",
    "estimate_full_time": f"""with {_RUNS} select step, elapsed_s * 8700 /
 nullif(num_generations::double * batch_size * exit_code, 0) / 60 as full_minutes from parsed""",
    "run_status": f"""with {_RUNS} select run_id, step, case when n_samples = 0 and elapsed_s <= 3 then 'failed_to_start'
 when exit_code <> 0 then 'abnormal_exit' else 'ok' end as status from runs""",
    "peak_memory": """select user_id % 7 as run_id, round(max(value / 64), 6) as peak_allocated_gb,
 round(max(value / 32), 6) as peak_reserved_gb, round(max(value / 32) * 100.0::double / 24, 6) as utilisation_pct
from events group by 1""",
    "running_accuracy": f"""with {_GRADED}, t as (select run_id, sample_idx,
 cast(count(*) over w as bigint) as seen, cast(sum(case when correct then 1 else 0 end) over w as bigint) as correct_so_far from graded
 window w as (partition by run_id order by sample_idx rows between unbounded preceding and current row))
select *, round(correct_so_far * 100.0::double / seen, 6) as accuracy from t""",
    "running_accuracy_lagged": f"""with {_GRADED}, b as (select run_id, sample_idx // 8 as batch_id, count(*) as n,
 count(*) filter (where correct) as c from graded group by 1, 2),
t as (select run_id, batch_id, cast(sum(n) over w as bigint) as batch_end, cast(sum(c) over w as bigint) - c as correct_so_far from b
 window w as (partition by run_id order by batch_id rows between unbounded preceding and current row))
select *, round(correct_so_far * 100.0::double / batch_end, 6) as accuracy from t""",
    "assign_batches": """with i as (select o_orderkey, row_number() over (order by o_orderkey) - 1 as sample_idx from orders)
select *, sample_idx // 32 as batch_id, cast(sample_idx % 32 as integer) as batch_pos from i""",
    "assign_batches_by_key": """with i as (select doc_id, row_number() over (order by lang, source, doc_id) - 1 as sample_idx from documents)
select *, sample_idx // 32 as batch_id, cast(sample_idx % 32 as integer) as batch_pos from i""",
    "batch_token_stats": f"""with {_RESPONSES}, {_BATCHED}, b as (select run_id, batch_id, count(*) as n_rows,
 max(input_tokens) as padded_input, max(output_tokens) as padded_output, cast(sum(input_tokens) as bigint) as i,
 cast(sum(output_tokens) as bigint) as o from batched group by 1, 2)
select run_id, batch_id, n_rows, padded_input, padded_output, n_rows * padded_input - i as input_padding,
 n_rows * padded_output - o as output_padding,
 round(100.0::double - (i + o) * 100.0::double / (n_rows * (padded_input + padded_output)), 6) as padding_pct from b""",
    "group_advantage": f"""with {_GRADED}, m as (select sample_idx, gen, reward, avg(reward) over (partition by sample_idx) as mean from graded)
select sample_idx, gen, reward, round(mean, 6) as group_mean, round(reward - mean, 6) as advantage from m""",
    "group_stats": f"""with {_GRADED} select sample_idx, count(*) as group_size, round(avg(reward), 6) as mean_reward,
 max(reward) as best_reward, min(reward) as worst_reward, max(reward) > 0 as any_correct, max(reward) = min(reward) as zero_spread from graded group by sample_idx""",
    "best_worst": f"with {_GRADED}, {_BEST_WORST} select * from ends",
    "build_chat_solution": f"with {_QA} select sample_idx, {_MESSAGES}, {_gold('answer', 'basic')} as solution from qa",
    "build_sft_pairs": f"with {_QA} select sample_idx, question as prompt, answer as response from qa",
    "build_preference_pairs": f"""with {_GRADED}, {_BEST_WORST} select sample_idx, question as prompt, best_response as chosen,
 worst_response as rejected from ends join qa using (sample_idx) where best_reward > worst_reward""",
    "build_reward_rows": f"with {_GRADED} select sample_idx, gen, question as prompt, response, reward from graded",
    "generate_responses": f"""with {_QA}, p as ({_CONFIG_ROWS}) select *, 'Answer: ' || cast(length(prompt) as varchar) as response,
 cast(length(prompt) as integer) as input_tokens,
 cast(length('Answer: ' || cast(length(prompt) as varchar)) as integer) as output_tokens from p""",
    "run_evaluation": f"""with {_QA}, replies as (select q.*, o_custkey % 97 + o_orderkey % 13 as total,
 {_gold('q.answer', 'basic')} as gold from qa q join orders on sample_idx = o_orderkey),
c as (select count(*) as total_samples, count(*) filter (where coalesce(abs(try_cast(gold as double) - total) < 0.001, false)) as correct_count,
 count(*) filter (where length('The answer: ' || cast(total as varchar)) >= 14) as truncated_count from replies)
select config, total_samples, correct_count, total_samples - correct_count as incorrect_count, truncated_count,
 {_ACCURACY.format(n='total_samples')} from c, unnest(['no_system', 'standard', 'cot']) as t(config)""",
    "stream_running_accuracy": """with c as (select user_id % 5 as run_id, count(*) as seen, count(*) filter (where value > 10) as
 correct_so_far from events group by 1) select *, round(correct_so_far * 100.0::double / seen, 6) as accuracy from c""",
    "stream_resource_windows": f"""with {_SAMPLES} select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as window_start, config,
 max(used_mb / 1024) as max_gb, round(avg(used_mb / 1024), 12) as avg_gb, count(*) as n_samples from samples group by 1, 2""",
    "stream_peak_memory": """select user_id % 7 as run_id, round(max(value / 64), 6) as peak_allocated_gb,
 round(max(value / 32), 6) as peak_reserved_gb from events group by 1""",
}
