"""DuckDB form of the registered queries, for the correctness check.

Written independently of the Spark plans wherever that is possible: ranks come from plain window
functions, text is cleaned with DuckDB's own accent stripping, reports are computed per label.
"""

from __future__ import annotations

from ledgerlens import schema as S
from ledgerlens.functions.derive import derived_categories
from ledgerlens.functions.names import normalise_name
from ledgerlens.plans import standin
from ledgerlens.plans.standin import commitments_sql

ORACLES: dict[str, str] = {}

# Portuguese stopwords that can match ASCII text of two letters or more, and the
# domain words.
STOPWORDS = """
de que do da em um para com uma os no se na por mais as dos como mas ao ele das seu sua ou quando
muito nos eu pelo pela isso ela entre depois sem mesmo aos seus quem nas me esse eles essa num nem
suas meu minha numa pelos elas qual lhe deles essas esses pelas este dele tu te vos lhes meus
minhas teu tua teus tuas nosso nossa nossos nossas dela delas esta estes estas aquele aquela
aqueles aquelas isto aquilo estou estamos estive esteve estivemos estiveram estava estavam
estivera esteja estejamos estejam estivesse estivessem estiver estivermos estiverem hei havemos
houve houvemos houveram houvera haja hajamos hajam houvesse houvessem houver houvermos houverem
houverei houveremos houveria houveriam sou somos era eram fui foi fomos foram fora seja sejamos
sejam fosse fossem for formos forem serei seremos seria seriam tenho tem temos tinha tinham tive
teve tivemos tiveram tivera tenha tenhamos tenham tivesse tivessem tiver tivermos tiverem terei
teremos teria teriam
pdf total mes goias go
""".split()

FLOOR = 200


def names(columns: list[str]) -> str:
    return ", ".join(f'"{c}"' for c in columns)


def base(*columns: str, where: str = "", extra: str = "") -> str:
    """``with commitments as (...)`` plus further CTEs."""
    more = f", {extra}" if extra else ""
    condition = f" where {where}" if where else ""
    return f"with commitments as (select * from ({commitments_sql(*columns)}){condition}){more} "


CODED = (S.ID, S.CODE, S.BALANCE)
EXPIRED = f"expired as ({standin.EXPIRED_SQL})"

# --- projections and filters ---------------------------------------------------------------

ORACLES["regularized_projection"] = base() + "select " + names(
    [normalise_name(h) for h in S.SOURCE_HEADERS]) + " from commitments"
for kind, columns in S.COLUMN_SETS.items():
    ORACLES[f"projection_{kind}"] = base(*columns) + f"select {names(columns)} from commitments"

ORACLES["filter_year"] = (
    base(S.ID, S.YEAR) + f"select * from commitments where {S.YEAR} >= 1998")
ORACLES["filter_dates"] = base(S.ID, S.PERIOD) + (
    "select * from commitments where periodo in ('1998/01/05', '1999/07/20', '2000/02/29')")
ORACLES["filter_daterange"] = base(S.ID, S.PERIOD) + (
    "select * from commitments where periodo >= '1999/01/01' and periodo <= '1999/03/31'")
ORACLES["filter_previous_day"] = base(S.ID, S.PERIOD) + (
    "select * from commitments where periodo = '2000/03/01'")
ORACLES["filter_orgaos"] = base(S.ID, S.PERIOD, S.ORGAN) + (
    "select * from commitments where periodo between '1999/01/01' and '1999/12/31' "
    "and orgao in ('NATION_3', 'NATION_7')")
ORACLES["split_zero_balance"] = base(*CODED) + (
    f"select *, case when {S.BALANCE} > 0 then 'kept' else 'dropped' end as side from commitments")
ORACLES["drop_class92"] = base(*CODED) + (
    "select * from commitments where not regexp_full_match("
    f"{S.CODE}, '\\d[.]\\d[.]\\d\\d[.]92[.]\\d\\d')")
ORACLES["drop_expired"] = base(*CODED, extra=EXPIRED) + (
    f"select * from commitments where {S.CODE} not in (select nat_despesa from expired)")
for name, floor in (("class_floor", FLOOR), ("singleton_floor", 2)):
    ORACLES[name] = base(*CODED) + (
        f"select * from commitments where {S.CODE} in (select {S.CODE} from commitments "
        f"group by 1 having count(*) >= {floor})")
ORACLES["sample_n"] = base(*CODED) + (
    f"select * from commitments order by md5({S.ID} || ':15'), {S.ID} limit 1000")

# --- scope and cleaning: the filter chain, stage by stage ----------------------------------

CHAIN = f"""{EXPIRED},
positive as (select * from commitments where {S.BALANCE} > 0),
no92 as (select * from positive where not regexp_full_match({S.CODE},
  '\\d[.]\\d[.]\\d\\d[.]92[.]\\d\\d')),
kept as (select * from no92 where {S.CODE} not in (select nat_despesa from expired)),
sizes as (select {S.CODE} as c, count(*) as n from kept group by 1),
sections as (select kept.*, case when n >= {FLOOR} then 'above' when n >= 2 then 'below' end
  as section from kept join sizes on c = {S.CODE})"""
SCOPE = f"""scope as (select distinct c.{S.CODE} as natureza,
  case when c.{S.CODE} in (select {S.CODE} from positive except select {S.CODE} from no92)
       then 'Classe 92'
       when c.{S.CODE} in (select {S.CODE} from no92 except select {S.CODE} from kept)
       then 'Classe com vigência expirada' else 'Em escopo' end as status from commitments c)"""

ORACLES["scope_map"] = base(*CODED, extra=f"{CHAIN}, {SCOPE}") + "select * from scope"
ORACLES["scope_store"] = ORACLES["scope_map"]
ORACLES["cleaning_sections"] = base(*CODED, extra=CHAIN) + (
    "select * from sections where section is not null")


def stage(number: int, name: str, kept: str, dropped: str) -> str:
    return f"""select cast({number} as int) as step_no, '{name}' as step,
    k.n as rows_kept, k.c as classes_kept, d.n as rows_dropped, d.c as classes_dropped
    from (select count(*) as n, count(distinct {S.CODE}) as c from {kept}) k,
         (select count(*) as n, count(distinct {S.CODE}) as c from {dropped}) d"""


ORACLES["cleaning_funnel"] = base(*CODED, extra=CHAIN) + " union all ".join([
    stage(0, "initial", "commitments", "(select * from commitments where false)"),
    stage(1, "positive_balance", "positive", f"(select * from commitments where {S.BALANCE} <= 0)"),
    stage(2, "not_element_92", "no92",
          "(select * from positive except all select * from no92)"),
    stage(3, "not_expired", "kept", "(select * from no92 except all select * from kept)"),
    stage(4, "above_floor", "(select * from sections where section = 'above')",
          "(select * from sections where section = 'below' or section is null)"),
    stage(5, "below_floor", "(select * from sections where section = 'below')",
          "(select * from sections where section is null)"),
])
ORACLES["class_frequencies"] = base(S.CODE) + (
    f"select {S.CODE}, count(*) as n from commitments group by 1")
ORACLES["class_count"] = base(S.CODE) + (
    f"select count(distinct {S.CODE}) as n_classes from commitments")

# Inference population: from 2000 on, with the scope map of the earlier years.
INFERENCE = (
    f"with everything as ({commitments_sql(*CODED, S.PERIOD, S.YEAR, 'order_key', 'customer_key')}),"
    f" commitments as (select * from everything where {S.YEAR} < 2000), "
    # The expired list is drawn from all commitments.
    + CHAIN.replace(EXPIRED, EXPIRED.replace("from commitments", "from everything"))
    + f", {SCOPE}, noted as (select e.*, case when status is null then 'Classe desconhecida' "
    f"when status <> 'Em escopo' then status when {S.BALANCE} = 0 then 'Saldo zerado' end as note "
    f"from everything e left join scope on natureza = {S.CODE} where {S.YEAR} >= 2000) ")
NOTE_RESULT = ("case note when 'Classe desconhecida' then 'UNK' when 'Saldo zerado' then 'SNULO' "
               "when 'Classe 92' then 'C9' else 'CCVE' end")
RESULT = """case when declared = predicted then
  case verdict when 'INCORRETO' then 'INCV_M2' when 'OK' then 'C_M1-M2'
               when 'INCONCLUSIVO' then 'AD_M2' end
 else case verdict when 'INCORRETO' then 'INCT_M1-M2' when 'OK' then 'INCV_M1'
               when 'INCONCLUSIVO' then 'INCV_M1-AD_M2' end end"""

ORACLES["in_scope_rows"] = INFERENCE + (
    f"select {S.ID}, {S.CODE}, {S.BALANCE} from noted where note is null")
ORACLES["out_of_scope_verdicts"] = INFERENCE + (
    f"select {S.ID}, {S.CODE}, note as verdict, {NOTE_RESULT} as result "
    "from noted where note is not null")

GIVEN = (f"given as (select *, {S.CODE} as declared, {standin.PREDICTED_SQL} as predicted, "
         f"{standin.VERDICT_SQL} as verdict from commitments)")
KEYS = (S.ID, S.CODE, "order_key", "customer_key")
ORACLES["result_codes"] = base(*KEYS, extra=GIVEN) + (
    f"select {S.ID}, {RESULT} as resultado from given")

MERGED = INFERENCE + f""", predicted as (select *, {S.CODE} as declared,
  {standin.PREDICTED_SQL} as predicted, {standin.VERDICT_SQL} as verdict from noted),
results as (select {S.ID} as "Identificador", declared as "Natureza Real",
  coalesce(note, predicted) as "Natureza Predita", coalesce(note, verdict) as "Corretude",
  '02/03/2000' as "Data Predicao",
  case when note is null then {RESULT} else {NOTE_RESULT} end as "Resultado" from predicted) """
ORACLES["inference_job"] = MERGED + "select * from results"
ORACLES["results_sink"] = ORACLES["inference_job"]
ORACLES["result_distribution"] = MERGED + (
    'select "Resultado", count(*) as n from results group by 1')

ORACLES["keyed_merge"] = f"""with items as (select cast(l_orderkey as varchar) as id,
  'c' || cast(l_partkey % 5 as varchar) as code,
  case when l_suppkey % 3 = 0 then 'Classe 92' when l_suppkey % 7 = 0 then 'Saldo zerado' end as note,
  'c' || cast((l_partkey + l_linenumber % 2) % 5 as varchar) as p,
  case when l_linenumber % 3 = 0 then 'OK' when l_linenumber % 3 = 1 then 'INCORRETO'
       else 'INCONCLUSIVO' end as v, l_shipdate, l_linenumber, l_extendedprice from lineitem),
noted as (select *, coalesce(note, p) as told, coalesce(note, v) as judged from items),
last_row as (select id, code as declared, row_number() over (partition by id order by
  l_shipdate desc, l_linenumber desc, l_extendedprice desc, code desc) as rn from noted),
last_note as (select id, note, told as predicted, judged as verdict,
  row_number() over (partition by id order by (note is null) desc, l_shipdate desc,
  l_linenumber desc, l_extendedprice desc, told desc, judged desc) as rn from noted)
select r.id as "Identificador", declared as "Natureza Real", predicted as "Natureza Predita",
  verdict as "Corretude", '02/03/2000' as "Data Predicao",
  case when note is null then {RESULT} else {NOTE_RESULT} end as "Resultado"
from last_row r join last_note n on r.id = n.id where r.rn = 1 and n.rn = 1"""

ORACLES["ensemble_pick"] = base(*KEYS, extra=GIVEN) + f"""select {S.ID},
  case when greatest(customer_key % 97, customer_key * 3 % 97, customer_key * 5 % 97) / 97.0::double
         >= greatest(order_key % 89, order_key * 7 % 89) / 89.0::double
       then declared else predicted end as picked from given"""

# --- derived features and encodings --------------------------------------------------------

MONTH = "cast(month(order_date) as int)"
ORACLES["month_feature"] = base(S.ID, "order_date") + (
    f"select {S.ID}, {MONTH} as mes from commitments")
ORACLES["month_from_serial"] = ORACLES["month_feature"]
JURIDICA = f"cast({S.CPF} = '-' as int)"
SUCEDIDO = f"cast({S.ORGAN} <> {S.SUCCESSOR} as int)"
ACTION = "substr(acao, 8) || ' & ' || substr(programa, 8)"
ORACLES["flags"] = base(S.ID, S.CPF, S.ORGAN, S.SUCCESSOR) + (
    f"select {S.ID}, {JURIDICA} as pessoa_juridica, {SUCEDIDO} as orgao_sucedido from commitments")
ORACLES["action_program"] = base(S.ID, "acao", "programa") + (
    f"select {S.ID}, {ACTION} as acao_programa from commitments")
PLAIN = ["tipo_administracao_nome", "tipo_poder_nome", "funcao", "subfuncao",
         "modalidade_licitacao_nome", "fonte_recurso_nome"]
ORACLES["prepared_features"] = base(
    S.ID, S.SUCCESSOR, *PLAIN, S.PROCESS, "order_date", S.CPF, S.ORGAN, "acao", "programa",
    S.HISTORY, *S.AMOUNTS,
) + (f"select {S.ID}, {S.SUCCESSOR}, {names(PLAIN)}, {S.PROCESS}, {MONTH} as periodo, "
     f"{JURIDICA} as pessoa_juridica, {SUCEDIDO} as orgao_sucedido, {ACTION} as acao_programa, "
     f"{S.HISTORY}, {names(S.AMOUNTS)} from commitments")


def quotas(source: str, label: str, percent: int) -> str:
    """CTEs class_sizes and quotas."""
    return f"""class_sizes as (select {label} as label, count(*) as n from {source} group by 1),
shares as (select label, n, (n * wanted) // total as whole, (n * wanted) % total as remainder,
  wanted from (select *, sum(n) over () as total,
               (sum(n) over () * {percent} + 99) // 100 as wanted from class_sizes)),
quotas as (select label, n, cast(whole + case when row_number() over
  (order by remainder desc, label) <= wanted - sum(whole) over () then 1 else 0 end as bigint)
  as quota from shares)"""


def split(source: str, label: str, percent: int) -> str:
    """CTEs up to ``split``: the source with ``is_test``."""
    return f"""{quotas(source, label, percent)},
split as (select s.* exclude (rk), rk <= quota as is_test from (select *, row_number() over (
  partition by {label} order by md5({S.ID} || ':15'), {S.ID}) as rk from {source}) s
  join quotas on label = {label})"""


CODE_SPLIT = split("commitments", S.CODE, 30)
ORACLES["stratified_quota"] = base(S.CODE, extra=quotas("commitments", S.CODE, 30)) + (
    f"select label as {S.CODE}, n, quota from quotas")
ORACLES["stratified_split"] = base(S.ID, S.CODE, extra=CODE_SPLIT) + "select * from split"
ORACLES["process_count_fit"] = base(S.ID, S.CODE, S.PROCESS, extra=CODE_SPLIT) + (
    f"select {S.PROCESS}, count(*) as n from split where not is_test group by 1")
ORACLES["process_count_apply"] = base(S.ID, S.CODE, S.PROCESS, extra=CODE_SPLIT) + (
    f"select {S.ID}, {S.PROCESS}, cast((select count(*) from split f where not f.is_test "
    f"and f.{S.PROCESS} = t.{S.PROCESS}) as double) as empenhos_por_processo "
    "from split t where is_test")
# Classes laid end to end in label order and dealt round robin give the fold sizes; each class
# then fills its folds in hash order.
ORACLES["stratified_folds"] = base(S.ID, S.CODE) + f"""select i.{S.ID}, i.{S.CODE},
  cast(case when rk <= f0 then 0 when rk <= f0 + f1 then 1 else 2 end as int) as fold
from (select *, row_number() over (partition by {S.CODE} order by md5({S.ID} || ':15'), {S.ID}) as rk
  from commitments) i
join (select {S.CODE}, count(*) filter (p % 3 = 0) as f0, count(*) filter (p % 3 = 1) as f1
  from (select {S.CODE}, row_number() over (order by {S.CODE}) - 1 as p from commitments)
  group by 1) d on d.{S.CODE} = i.{S.CODE}"""
ORACLES["label_encode"] = base(S.ID, S.CODE) + (
    f"select {S.ID}, {S.CODE}, cast(dense_rank() over (order by {S.CODE}) - 1 as int) as code "
    "from commitments")

ORACLES["label_decode"] = base(*KEYS, extra=GIVEN) + (
    f"select {S.ID}, predicted as label from given")

ORACLES["minmax_fit"] = base(*S.AMOUNTS) + " union all ".join(
    f"select '{c}' as \"column\", min({c}) as low, max({c}) as high from commitments"
    for c in S.AMOUNTS)
ORACLES["minmax_apply"] = base(S.ID, S.YEAR, *S.AMOUNTS) + f"select {S.ID}, " + ", ".join(
    f"round(case when high_{c} = low_{c} then {c} - low_{c} "
    f"else ({c} - low_{c}) / (high_{c} - low_{c}) end, 6) as {c}" for c in S.AMOUNTS
) + " from commitments, (select " + ", ".join(
    f"min({c}) as low_{c}, max({c}) as high_{c}" for c in S.AMOUNTS
) + f" from commitments where {S.YEAR} < 2000)"

CATEGORIES = derived_categories(S.CODE_CATEGORIES)
CELL = {S.PERIOD: MONTH, "pessoa_juridica": JURIDICA, "orgao_sucedido": SUCEDIDO,
        "acao_programa": ACTION}
CELLS = "cells as (" + " union all ".join(
    f"select {S.ID}, {S.YEAR}, '{c}' as \"column\", cast({CELL.get(c, c)} as varchar) as value "
    "from commitments" for c in CATEGORIES) + ")"
CELL_SOURCE = (S.ID, S.YEAR, S.SUCCESSOR, *PLAIN, "order_date", S.CPF, S.ORGAN, "acao", "programa")
VOCABULARY = ("select \"column\", value, cast(row_number() over (partition by \"column\" "
              "order by value) - 1 as int) as \"index\" from (select distinct \"column\", value "
              "from cells {where})")
ORACLES["category_vocab"] = base(*CELL_SOURCE, extra=CELLS) + VOCABULARY.format(where="")
ORACLES["onehot_long"] = base(
    *CELL_SOURCE,
    extra=f"{CELLS}, vocab as ({VOCABULARY.format(where=f'where {S.YEAR} < 1997')})",
) + f'select {S.ID}, c."column", "index" from cells c join vocab v using ("column", value)'

# --- text ----------------------------------------------------------------------------------

NO_PUNCTUATION = "regexp_replace(text, '[[:punct:]]', ' ', 'g')"
CLEAN = (f"trim(regexp_replace(regexp_replace(strip_accents(replace(lower({NO_PUNCTUATION}), "
         "'ß', 'ss')), '[^a-z\\s]', '', 'g'), '\\s+', ' ', 'g'))")
ORACLES["punctuation"] = f"select doc_id, {NO_PUNCTUATION} as plain from documents"
ORACLES["clean_text"] = f"select doc_id, {CLEAN} as clean from documents"
STOPLIST = ", ".join(f"'{word}'" for word in STOPWORDS)
TOKENS = f"""tokens as (select doc_id, word, pos from (select doc_id,
  unnest(string_split(clean, ' ')) as word, generate_subscripts(string_split(clean, ' '), 1) as pos
  from (select doc_id, {CLEAN} as clean from documents))
  where length(word) > 1 and word not in ({STOPLIST}))"""
ORACLES["stopword_filter"] = f"""with {TOKENS} select d.doc_id, coalesce(kept, '') as kept
from documents d left join (select doc_id, string_agg(word, ' ' order by pos) as kept from tokens
group by 1) t on t.doc_id = d.doc_id"""
ORACLES["document_frequency"] = (
    f"with {TOKENS} select word as term, count(distinct doc_id) as df from tokens group by 1")

C, V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
M0, M1 = f"^({C})?{V}{C}", f"^({C})?{V}{C}{V}{C}"
M_IS_1 = f"^({C})?{V}{C}({V})?$"
SHORT = f"^({C}[aeiouy][^aeiouwxy]|[aeiou][^aeiou])$"


def has(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, '{pattern}')"


def drop(letters: int, word: str = "w") -> str:
    return f"left({word}, length({word}) - {letters})"


def endings(swaps: dict[str, str], measure: str) -> str:
    """CASE over suffixes, longest first: the first one that fits decides."""
    branches = []
    for suffix in sorted(swaps, key=len, reverse=True):
        rest = drop(len(suffix))
        tested = drop(3) if suffix == "logi" else rest
        condition = has(tested, measure)
        if suffix == "ion":
            condition += f" and {has(rest, '[st]$')}"
        branches.append(f"when suffix(w, '{suffix}') then case when {condition} "
                        f"then {rest} || '{swaps[suffix]}' else w end")
    return "case " + " ".join(branches) + " else w end"


def repaired(rest: str) -> str:
    return (f"case when not {has(rest, f'^({C})?[aeiouy]')} then w "
            f"when {has(rest, '(at|bl|iz)$')} then {rest} || 'e' "
            f"when length({rest}) > 1 and right({rest}, 2) = right({rest}, 1) || right({rest}, 1) "
            f"and not {has(rest, '[aeiou]$')} then case when {has(rest, '[lsz]$')} then {rest} "
            f"else left({rest}, length({rest}) - 1) end "
            f"when {has(rest, SHORT)} then {rest} || 'e' else {rest} end")


def stems(source: str) -> str:
    """CTEs from distinct ``word`` of a source to ``stems`` (word, stem)."""
    from ledgerlens.functions.stemming import IRREGULAR, STEP_2, STEP_3, STEP_4

    i_or_ie = f"case when length(w) = 4 then {drop(1)} else {drop(2)} end"
    steps = [
        f"case when suffix(w, 'sses') then {drop(2)} when suffix(w, 'ies') then {i_or_ie} "
        f"when suffix(w, 'ss') then w when suffix(w, 's') then {drop(1)} else w end",
        f"case when suffix(w, 'ied') then {i_or_ie} when suffix(w, 'eed') then "
        f"case when {has(drop(3), M0)} then {drop(1)} else w end "
        f"when suffix(w, 'ed') then {repaired(drop(2))} "
        f"when suffix(w, 'ing') then {repaired(drop(3))} else w end",
        f"case when {has('w', '.[^aeiou]y$')} then {drop(1)} || 'i' else w end",
        f"case when suffix(w, 'alli') and {has(drop(4), M0)} then {drop(2)} else w end",
        endings(STEP_2, M0), endings(STEP_3, M0), endings(dict.fromkeys(STEP_4, ""), M1),
        f"case when suffix(w, 'e') and ({has(drop(1), M1)} or ({has(drop(1), M_IS_1)} "
        f"and not {has(drop(1), SHORT)})) then {drop(1)} else w end",
        f"case when suffix(w, 'll') and {has(drop(1), M1)} then {drop(1)} else w end",
    ]
    ctes = [f"s0 as (select distinct word, regexp_replace(word, '^y', 'Y') as w from {source})"]
    for at, step in enumerate(steps):
        ctes.append(f"s{at + 1} as (select word, {step} as w from s{at})")
    irregular = " ".join(f"when '{word}' then '{stem}'" for word, stem in IRREGULAR.items())
    ctes.append(f"stems as (select word, case word {irregular} else case when length(word) <= 2 "
                f"then word else lower(w) end end as stem from s{len(steps)})")
    return ", ".join(ctes)


ORACLES["stem_dictionary"] = f"with {TOKENS}, {stems('tokens')} select word, stem from stems"


def tfidf(term: str, source: str) -> str:
    return f"""tf as (select doc_id, {term} as term, count(*) as tf from {source}
  where length({term}) > 1 group by 1, 2),
idf as (select term, ln((1.0 + (select count(*) from documents)) / (1.0 + count(*))) + 1.0 as idf
  from tf group by 1),
raw as (select doc_id, term, tf * idf as raw from tf join idf using (term))
select doc_id, term, round(raw / sqrt(sum(raw * raw) over (partition by doc_id)), 6) as weight
from raw"""


ORACLES["tfidf_long"] = f"with {TOKENS}, {tfidf('word', 'tokens')}"
ORACLES["tfidf_stemmed"] = (
    f"with {TOKENS}, {stems('tokens')}, {tfidf('stem', '(tokens join stems using (word))')}")

# --- encoded rows: sums over the cells of each block ---------------------------------------

ALL_WORDS = f"""all_words as (select doc_id, word from (select doc_id,
  unnest(string_split(clean, ' ')) as word from (select doc_id, {CLEAN} as clean from documents))
  where word <> '')"""


def projected(term: str, source: str, width: int, shortest: int) -> str:
    """CTEs to ``text_cells`` (doc_id, position, value): weighted terms, where a document counts
    as often as commitments have it, with sign and position by the digits of their md5."""
    return f"""uses as (select doc_id, count(*) as uses from commitments group by 1),
tf as (select doc_id, {term} as term, count(*) as tf from {source}
  where length({term}) >= {shortest} group by 1, 2),
idf as (select term, ln((1.0 + (select count(*) from commitments)) / (1.0 + sum(uses))) + 1.0 as idf
  from tf join uses using (doc_id) group by 1),
raw as (select doc_id, term, tf * idf as raw from tf join idf using (term)),
unit as (select doc_id, md5(term) as digest, raw / sqrt(sum(raw * raw) over (partition by doc_id))
  as weight from raw),
text_cells as (select doc_id, ('0x' || substr(digest, 1, 8))::bigint % {width} as position,
  sum(case when ('0x' || substr(digest, 9, 1))::int % 2 = 0 then weight else -weight end) as value
  from unit group by 1, 2)"""


SUMS = ("count(*) as n, round(sum(value), 6) as total, "
        "round(sum(value * position), 6) as weighted")
ORACLES["dense_text"] = base(
    S.ID, "doc_id", extra=f"{ALL_WORDS}, {projected('word', 'all_words', 100, 1)}",
) + f"select {S.ID}, {SUMS} from commitments join text_cells using (doc_id) group by 1"


ORACLES["word_association"] = f"""with listed as (
  select doc_id, list_filter(string_split({CLEAN}, ' '), lambda w: w <> '') as w from documents),
words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from listed),
near as (
  select x.word as a, y.word as b from words x join words y on x.doc_id = y.doc_id
    and y.i - x.i between -5 and 5 and y.i <> x.i),
counts as (select a, b, cast(count(*) as bigint) as n from near group by 1, 2),
totals as (select a as word, sum(n) as total from counts group by 1),
scored as (
  select a, n, ln(n * (select sum(n) from counts)::double / (t.total::double * u.total::double))
    as value
  from counts join totals t on t.word = a join totals u on u.word = b)
select a as word, count(*) as partners, cast(sum(n) as bigint) as n,
       round(sum(value), 4) as association
from scored where value > 0 group by 1"""


def encoded(categories: list[str], more: tuple[str, ...] = ()) -> str:
    columns = derived_categories(categories)
    cells = " union all ".join(
        f"select {S.ID}, '{c}' as \"column\", cast({CELL.get(c, c)} as varchar) as value "
        "from commitments" for c in columns)
    order = ", ".join(f"('{c}', {i})" for i, c in enumerate(columns))
    amounts = [*S.AMOUNTS, "process_count"]
    scaled = " union all ".join(
        f"select {S.ID}, {i} as position, case when h = l then {c} - l else ({c} - l) / (h - l) end "
        f"as value from counted, (select min({c}) as l, max({c}) as h from counted)"
        for i, c in enumerate(amounts))
    return base(
        *dict.fromkeys((*CELL_SOURCE, *more, S.PROCESS, "doc_id", *S.AMOUNTS)),
        extra=f"""cells as ({cells}), vocab as ({VOCABULARY.format(where="")}),
offsets as (select "column", sum(n) over (order by place) - n as start from
  (select "column", count(*) as n from vocab group by 1)
  join (values {order}) o("column", place) using ("column")),
counted as (select *, cast(count(*) over (partition by {S.PROCESS}) as double) as process_count
  from commitments),
scaled as ({scaled}), {TOKENS}, {stems('tokens')},
{projected('stem', '(tokens join stems using (word))', 1024, 2)}""",
    ) + f"""select {S.ID}, 'amount' as block, {SUMS} from scaled where value <> 0 group by 1
union all select {S.ID}, 'category', {SUMS} from (select {S.ID}, 1.0::double as value,
  start + "index" as position from cells join vocab using ("column", value)
  join offsets using ("column")) group by 1
union all select {S.ID}, 'text', {SUMS} from commitments join text_cells using (doc_id) group by 1"""


ORACLES["encoded_code"] = encoded(S.CODE_CATEGORIES)
ORACLES["anomaly_features"] = encoded(S.ANOMALY_CATEGORIES, (
    "grupo_despesa", "elemento_despesa", S.CODE, "natureza_despesa_nome", "formalidade_nome"))

# --- reports -------------------------------------------------------------------------------

METRICS = '"precision", recall, "f1-score", support'


def report(source: str, true: str, predicted: str, group: str = "''") -> str:
    """CTEs up to ``report`` (grp, label, metrics), from (true, predicted) pairs."""
    return f"""pairs as (select {group} as grp, {true} as t, {predicted} as p from {source}),
labels as (select grp, t as label from pairs union select grp, p from pairs),
tallies as (select l.grp, label,
  (select count(*) from pairs x where x.grp = l.grp and t = label and p = label) as hits,
  (select count(*) from pairs x where x.grp = l.grp and p = label) as told,
  (select count(*) from pairs x where x.grp = l.grp and t = label) as support from labels l),
metrics as (select grp, label, hits,
  case when told > 0 then hits / told::double else 0 end as "precision",
  case when support > 0 then hits / support::double else 0 end as recall,
  2 * hits / (told + support)::double as "f1-score", support::double as support from tallies),
accuracies as (select grp, sum(hits) / sum(support) as a, sum(support) as n from metrics group by 1),
report as (select grp, label, {METRICS} from metrics
  union all select grp, 'accuracy', a, a, a, a from accuracies
  union all select grp, 'macro avg', avg("precision"), avg(recall), avg("f1-score"), sum(support)
    from metrics group by 1
  union all select grp, 'weighted avg', sum("precision" * support) / sum(support),
    sum(recall * support) / sum(support), sum("f1-score" * support) / sum(support), sum(support)
    from metrics group by 1)"""


ROUNDED = ", ".join(f'round({m}, 6) as {m}' for m in METRICS.split(", "))
GIVEN_REPORT = base(*KEYS, extra=f"{GIVEN}, {report('given', 'declared', 'predicted')}")
ORACLES["class_report"] = GIVEN_REPORT + f"select label, {ROUNDED} from report"
ORACLES["report_sink"] = ORACLES["class_report"]
ORACLES["macro_micro_f1"] = GIVEN_REPORT + (
    'select round((select avg("f1-score") from metrics), 6) as macro_f1, round(a, 6) as micro_f1, '
    "round(a, 6) as accuracy from accuracies")
HELD_OUT = split("given", S.CODE, 30) + ", held_out as (select * from split where is_test)"
ORACLES["special_report"] = base(
    *KEYS, extra=f"{GIVEN}, {HELD_OUT}, {report('held_out', 'declared', 'predicted')}",
) + f"""select r.label, {ROUNDED},
  round(case when r.label = 'accuracy' then "precision" when r.label like '% avg' then total
        else n end, 6) as "n docs",
  round(case when r.label = 'accuracy' then "precision" when r.label like '% avg' then 1
        else n / total end, 6) as "percent of total"
from report r left join class_sizes s on s.label = r.label,
  (select count(*)::double as total from commitments)"""

VALIDATED = (f"validated as (select g.*, {standin.ANALISE_SQL} as analise from given g "
             "join (select doc_id as d, quality, toxic from labels) on d = doc_id)")
ORACLES["report_by_verdict"] = base(
    *KEYS, "doc_id",
    extra=f"{GIVEN}, {VALIDATED}, {report('validated', 'declared', 'predicted', 'analise')}",
) + f"select grp as analise, label, {ROUNDED} from report"
# Both reports of the hold-out run as one: a pair per slice and row.
ORACLES["evaluation_job"] = base(
    *KEYS, "doc_id",
    extra=f"{GIVEN}, {VALIDATED}, {split('validated', 'analise', 20)}, slices as ("
    "select analise as slice, declared as t0, predicted as p0 from split where is_test union all "
    "select 'correctness', analise, verdict from split where is_test), "
    + report("slices", "t0", "p0", "slice"),
) + f"select grp as slice, label, {ROUNDED} from report"

ORACLES["best_candidate"] = base(*KEYS, S.ORGAN, "formalidade_nome", extra=GIVEN) + f"""
select {S.ORGAN}, candidate, accuracy from (select *, row_number() over (partition by {S.ORGAN}
  order by accuracy desc, candidate) as rn from (select {S.ORGAN}, formalidade_nome as candidate,
  round(avg(case when declared = predicted then 1.0 else 0.0 end), 2) as accuracy
  from given group by 1, 2)) where rn = 1"""

# --- sources and sinks ---------------------------------------------------------------------

ORACLES["csv_scan"] = ORACLES["regularized_projection"]
ORACLES["json_sink"] = base(*CODED) + "select * from commitments"
ORACLES["side_table_scan"] = base(S.CODE) + standin.EXPIRED_SQL
