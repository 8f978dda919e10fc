"""Independent SQL twins of the catalog queries (DuckDB dialect).

They use plain global windows (``row_number() over (order by ...)``,
``sum(...) over (order by row_id)``) where the Spark side uses two-level
scans, so agreement checks the scans too.  The tables are the views of the
same names.
"""

from __future__ import annotations

from ..config import DEFAULT

_C = DEFAULT
SEED = str(_C.seed)
B = _C.pair_budget
SEQ = _C.seq_len
BS = _C.batch_size
EPOCHS = _C.num_epochs
P_MLM = _C.mlm_probability
SPECIALS = _C.special_tokens

# The bijection of the epoch order, and walks enough for the tables' sizes.
FEISTEL = 6
SEARCH, WIDEST = 1 << 20, 4
TWIN_WALKS = 6

# Same classes as the Spark patterns in functions.text, spelled for RE2.
STRIP_RE = r"^[\s\p{Z}\x0b\x1c-\x1f\x{85}]+|[\s\p{Z}\x0b\x1c-\x1f\x{85}]+$"
WORD_RE = r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]+|[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\s\p{Z}]+"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '{STRIP_RE}', '', 'g')"


def _words(x: str) -> str:
    return f"regexp_extract_all({x}, '{WORD_RE}')"


def _lookup_words(x: str) -> str:
    """Words with special tokens kept whole: each is one character of private use while the
    text is split (no text of the tables holds these)."""
    low, high = 0xE000, 0xE000 + len(SPECIALS) - 1
    for i, t in enumerate(SPECIALS):
        x = f"replace({x}, '{t}', chr({low + i}))"
    own = rf"\x{{{low:X}}}-\x{{{high:X}}}"
    pattern = f"[{own}]|" + WORD_RE.replace("[^", f"[^{own}")
    cases = " ".join(f"WHEN w = chr({low + i}) THEN '{t}'" for i, t in enumerate(SPECIALS))
    return f"list_transform(regexp_extract_all({x}, '{pattern}'), lambda w: CASE {cases} ELSE w END)"


def _md5(tag: str, *keys: str) -> str:
    ks = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"md5(concat_ws('|', '{SEED}', '{tag}', {ks}))"


def _frac(h: str, start: int, length: int) -> str:
    return (
        f"(CAST(CAST('0x' || substr({h}, {start}, {length}) AS BIGINT) AS DOUBLE)"
        f" / CAST({16 ** length} AS DOUBLE))"
    )


def _u(tag: str, key: str) -> str:
    return _frac(_md5(tag, key), 1, 13)


M32, MIXC, WEYL = 0xFFFFFFFF, 0x45D9F3B, 0x9E3779B9


def _half(start: int, tag: str, *keys: str) -> str:
    return f"CAST('0x' || substr({_md5(tag, *keys)}, {start}, 8) AS BIGINT)"


def _rnd(x: str) -> str:
    return f"((xor(({x}) >> 16, ({x})) * {MIXC}) & {M32})"


def _draw(pos: str, j: int) -> str:
    """Draw j of a position: counter 3*pos+j of the first half ``k``, mixed with the second, ``k2``."""
    c = f"(((k) + (({pos}) * 3 + {j}) * {WEYL}) & {M32})"
    r = _rnd(f"xor({_rnd(c)}, k2)")
    return f"(CAST(xor(({r}) >> 16, ({r})) AS DOUBLE) / 4294967296.0::DOUBLE)"


DOCS_RAW = """
raw AS (
  SELECT (row_number() OVER (ORDER BY doc_id, p) - 1)::BIGINT AS row_id, raw AS text, FALSE AS is_start FROM (
    SELECT doc_id, generate_subscripts(a, 1) - 1 AS p, unnest(a) AS raw FROM (
      SELECT doc_id, list_concat([' = ' || source || ' = ', ''],
        flatten(list_transform(string_split(text, chr(10)),
          lambda x, i: CASE WHEN i % 5 = 0 THEN [x, ''] ELSE [x] END))) AS a
      FROM documents)))"""

CONV_RAW = """
raw AS (
  SELECT conv_id * 1048576 AS row_id, '' AS text, TRUE AS is_start
    FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id * 1048576 + turn + 1 AS row_id, text, FALSE AS is_start FROM conversations)"""


def _corpus(kind: str) -> list[str]:
    raw = DOCS_RAW if kind == "docs" else CONV_RAW
    if kind == "docs":
        flag = "CASE WHEN text = '' OR starts_with(text, '=') THEN 1 ELSE 0 END"
    else:
        flag = "CASE WHEN is_start OR text = '' THEN 1 ELSE 0 END"
    return [
        raw,
        f"stripped AS (SELECT row_id, {_strip('text')} AS text, is_start FROM raw)",
        "lines AS (SELECT row_id, text FROM stripped WHERE text <> '')",
        f"flagged AS (SELECT row_id, text, {flag} AS b FROM stripped)",
    ]


def _vocab() -> list[str]:
    specials = ", ".join(f"('{t}', {i}::BIGINT, 0::BIGINT)" for i, t in enumerate(SPECIALS))
    names = ", ".join(f"'{t}'" for t in SPECIALS)
    k = _C.vocab_size - len(SPECIALS)
    return [
        f"counts AS (SELECT token, count(*)::BIGINT AS n FROM (SELECT unnest({_words('text')}) AS token FROM lines) GROUP BY token)",
        f"""vocab AS (
  SELECT * FROM (VALUES {specials}) v(token, id, n)
  UNION ALL
  SELECT token, (row_number() OVER (ORDER BY n DESC, token) + {len(SPECIALS) - 1})::BIGINT AS id, n
  FROM (SELECT token, n FROM counts WHERE n >= {_C.min_frequency} AND token NOT IN ({names})
        ORDER BY n DESC, token LIMIT {k}))""",
        "vsize AS (SELECT count(*)::BIGINT AS v FROM vocab)",
    ]


def _sentences() -> list[str]:
    return [
        "segd AS (SELECT row_id, text, b, sum(b) OVER (ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS dk FROM flagged)",
        """sents_all AS (SELECT dk::BIGINT AS doc_key,
  (row_number() OVER (PARTITION BY dk ORDER BY row_id) - 1)::BIGINT AS sent_idx,
  count(*) OVER (PARTITION BY dk)::BIGINT AS n_sents, row_id, text FROM segd WHERE b = 0)""",
        f"sents AS (SELECT * FROM sents_all WHERE n_sents >= {_C.min_sentences})",
    ]


def _sentence_tokens() -> list[str]:
    return [
        f"""st_ex AS (SELECT row_id, generate_subscripts(tk, 1) AS pos, unnest(tk) AS token
  FROM (SELECT row_id, {_lookup_words('text')}[1:{B}] AS tk FROM sents))""",
        """st_ids AS (SELECT e.row_id, list(coalesce(v.id, 0)::BIGINT ORDER BY e.pos) AS ids
  FROM st_ex e LEFT JOIN vocab v ON v.token = e.token GROUP BY e.row_id)""",
        """sent_tok AS (SELECT s.doc_key, s.sent_idx, s.n_sents, s.row_id, coalesce(i.ids, []::BIGINT[]) AS ids
  FROM sents s LEFT JOIN st_ids i ON i.row_id = s.row_id)""",
    ]


def _pairs() -> list[str]:
    return [
        f"""docs AS (SELECT doc_key, n_sents,
  (row_number() OVER (ORDER BY doc_key) - 1)::BIGINT AS doc_idx
  FROM sent_tok WHERE sent_idx = 0)""",
        "nd AS (SELECT count(*)::BIGINT AS d FROM docs)",
        f"""p0 AS (SELECT a.row_id AS example_id, a.doc_key, a.sent_idx, a.ids,
  (CASE WHEN {_u('nsp', 'a.row_id')} < {_C.nsp_positive_probability} THEN 1 ELSE 0 END)::BIGINT AS is_next,
  CAST(floor({_u('doc', 'a.row_id')} * (nd.d - 1)) AS BIGINT) AS j, o.doc_idx AS own_idx
  FROM sent_tok a JOIN docs o ON o.doc_key = a.doc_key CROSS JOIN nd
  WHERE a.sent_idx < a.n_sents - 1)""",
        f"""p1 AS (SELECT p.example_id, p.doc_key, p.sent_idx, p.ids, p.is_next,
  CASE WHEN p.is_next = 1 THEN p.doc_key ELSE t.doc_key END AS b_doc_key,
  CASE WHEN p.is_next = 1 THEN p.sent_idx + 1
       ELSE CAST(floor({_u('sent', 'p.example_id')} * t.n_sents) AS BIGINT) END AS b_sent_idx
  FROM p0 p JOIN docs t ON t.doc_idx = (CASE WHEN p.j >= p.own_idx THEN p.j + 1 ELSE p.j END))""",
        """pairs AS (SELECT p.*, b.row_id AS b_id, b.ids AS ids_b
  FROM p1 p JOIN sent_tok b ON b.doc_key = p.b_doc_key AND b.sent_idx = p.b_sent_idx)""",
    ]


def _examples() -> list[str]:
    half_up, half_down = (B + 1) // 2, B // 2
    return [
        f"""ex2 AS (SELECT example_id, is_next, ids AS ids_a, ids_b,
  least(len(ids), greatest({half_up}, {B} - len(ids_b)))::BIGINT AS n_a,
  least(len(ids_b), greatest({half_down}, {B} - len(ids)))::BIGINT AS n_b FROM pairs)""",
        f"""long AS (SELECT example_id, is_next, n_a, n_b, r.pos::BIGINT AS pos,
  (CASE WHEN r.pos = 0 THEN 2 WHEN r.pos <= n_a THEN ids_a[r.pos] WHEN r.pos = n_a + 1 THEN 3
        WHEN r.pos <= n_a + n_b + 1 THEN ids_b[r.pos - n_a - 1] WHEN r.pos = n_a + n_b + 2 THEN 3
        ELSE 1 END)::BIGINT AS id,
  (CASE WHEN r.pos <= n_a + 1 THEN 0 WHEN r.pos <= n_a + n_b + 2 THEN 1 ELSE 0 END)::BIGINT AS seg,
  (CASE WHEN r.pos <= n_a + n_b + 2 THEN 1 ELSE 0 END)::BIGINT AS attn
  FROM ex2, range(0, {SEQ}) r(pos))""",
    ]


def _masked(epoch: int = 0) -> list[str]:
    mask_t = _C.mask_share
    rand_t = round(_C.mask_share + _C.random_share, 12)
    return [
        f"""mkey AS (SELECT example_id, {_half(1, 'mlm', str(epoch), 'example_id')} AS k,
  {_half(9, 'mlm', str(epoch), 'example_id')} AS k2 FROM ex2)""",
        """mh AS (SELECT l.*, CASE WHEN l.id NOT IN (1, 2, 3) THEN m.k END AS k, m.k2
  FROM long l JOIN mkey m ON m.example_id = l.example_id)""",
        f"""mm AS (SELECT *, (k IS NOT NULL AND {_draw('pos', 0)} < {P_MLM}) AS sel, {_draw('pos', 1)} AS br,
  CAST(floor({_draw('pos', 2)} * (SELECT v FROM vsize)) AS BIGINT) AS rid FROM mh)""",
        f"""masked AS (SELECT example_id, is_next, n_a, n_b, pos, seg, attn, id, sel, br,
  (CASE WHEN NOT sel THEN id WHEN br < {mask_t} THEN 4 WHEN br < {rand_t} THEN rid ELSE id END)::BIGINT AS input_id,
  (CASE WHEN sel THEN id ELSE -100 END)::BIGINT AS label FROM mm)""",
    ]


def _split() -> list[str]:
    return [
        "nex AS (SELECT count(*)::BIGINT AS n FROM pairs)",
        f"nval AS (SELECT greatest(1, floor({_C.validation_fraction}::DOUBLE * n))::BIGINT AS n_val, n FROM nex)",
        f"""spl AS (SELECT example_id,
  (row_number() OVER (ORDER BY {_md5('split', 'example_id')}, example_id) - 1)::BIGINT AS split_rank FROM pairs)""",
        """split AS (SELECT example_id, CASE WHEN split_rank < n_val THEN 'val' ELSE 'train' END AS split, split_rank
  FROM spl CROSS JOIN nval)""",
        f"spe AS (SELECT CAST(ceil((n - n_val) / {BS}.0) AS BIGINT) AS spe FROM nval)",
        *_train_slots(),
        f"""bv AS (SELECT 'val' AS split, r.epoch::BIGINT AS epoch, s.split_rank AS slot, s.example_id
  FROM split s, range(0, {EPOCHS}) r(epoch) WHERE s.split = 'val')""",
        f"""batches AS (SELECT split, epoch, (slot // {BS})::BIGINT AS batch_id, slot, example_id
  FROM (SELECT * FROM bt UNION ALL SELECT * FROM bv))""",
    ]


def _train_slots() -> list[str]:
    """Slots by the keyed bijection: halves ``a`` and ``b`` of the domain, rounds that add a mix of
    one half to the other, and walks for numbers that land beyond n."""
    low = "CAST(ceil(sqrt(n)) AS BIGINT)"
    parts = [
        "fn AS (SELECT n - n_val AS n FROM nval)",
        f"""fd AS (SELECT n, a, CAST(ceil(n / a::DOUBLE) AS BIGINT) AS b FROM (SELECT n, r.a FROM fn,
  range({low}, least({WIDEST} * {low}, {low} + {SEARCH}, greatest({low}, (n + 1) // 2)) + 1) r(a)
  ORDER BY (r.a - n % r.a) % r.a, r.a LIMIT 1))""",
        f"""fk AS (SELECT r.epoch::BIGINT AS epoch, {_half(1, 'shuffle', 'r.epoch')} AS k, {_half(9, 'shuffle', 'r.epoch')} AS k2
  FROM range(0, {EPOCHS}) r(epoch))""",
        """fx0 AS (SELECT k.epoch, s.example_id, k.k, k.k2, fd.n, fd.a, fd.b, s.split_rank - v.n_val AS x, TRUE AS fresh
  FROM split s, fk k, fd, nval v WHERE s.split = 'train')""",
    ]
    for w in range(TWIN_WALKS):
        parts.append(f"fr{w}_0 AS (SELECT *, x // b AS l, x % b AS r FROM fx{w})")
        for i in range(FEISTEL):
            half, size, moved = ("r", "a", "l") if i % 2 == 0 else ("l", "b", "r")
            key = f"((k + {(i + 1) * WEYL}) & {M32})"
            mixed = _rnd(f"xor({_rnd(f'xor({half}, {key})')}, k2)")
            step = f"(({moved} + xor(({mixed}) >> 16, ({mixed}))) % {size})"
            parts.append(f"fr{w}_{i + 1} AS (SELECT * REPLACE ({step} AS {moved}) FROM fr{w}_{i})")
        parts.append(
            f"""fx{w + 1} AS (SELECT * EXCLUDE (l, r) REPLACE (CASE WHEN fresh OR x >= n THEN l * b + r ELSE x END AS x, FALSE AS fresh)
  FROM fr{w}_{FEISTEL})"""
        )
    parts.append(f"bt AS (SELECT 'train' AS split, epoch, x::BIGINT AS slot, example_id FROM fx{TWIN_WALKS})")
    return parts


def _with(parts: list[str], select: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + select


def _docs_stack(top: str) -> list[str]:
    return _stack("docs", top)


_BUILDERS = {
    "vocab": _vocab,
    "sentences": _sentences,
    "tokens": _sentence_tokens,
    "pairs": _pairs,
    "examples": _examples,
    "masked": _masked,
    "split": _split,
}
_LEVELS = ["vocab", "sentences", "tokens", "pairs", "examples", "masked", "split"]


def _stack(kind: str, top: str) -> list[str]:
    """Corpus CTEs plus every level up to ``top`` (masking only when asked)."""
    parts = _corpus(kind)
    for name in _LEVELS[: _LEVELS.index(top) + 1]:
        if name == "masked" and top != "masked":
            continue
        parts += _BUILDERS[name]()
    return parts


def _training_select() -> str:
    return """SELECT example_id,
  string_agg(CAST(input_id AS VARCHAR), ' ' ORDER BY pos) AS input_ids,
  string_agg(CAST(attn AS VARCHAR), ' ' ORDER BY pos) AS attention_mask,
  string_agg(CAST(seg AS VARCHAR), ' ' ORDER BY pos) AS token_type_ids,
  string_agg(CAST(label AS VARCHAR), ' ' ORDER BY pos) AS labels,
  is_next AS next_sentence_label
FROM masked GROUP BY example_id, is_next"""


def _lr(step: str, total: str) -> str:
    w = float(_C.warmup_steps)
    return (
        f"(CAST({_C.learning_rate!r} AS DOUBLE) * CASE WHEN CAST({step} AS DOUBLE) < {w}::DOUBLE "
        f"THEN CAST({step} AS DOUBLE) / {float(max(1, _C.warmup_steps))}::DOUBLE "
        f"ELSE greatest(0.0::DOUBLE, 1.0::DOUBLE - (CAST({step} AS DOUBLE) - {w}::DOUBLE) / "
        f"CAST(greatest(1, {total} - {_C.warmup_steps}) AS DOUBLE)) END)"
    )


def _ce(logits: str, label: str) -> str:
    return (
        f"(ln(list_sum(list_transform({logits}, lambda x: exp(x::DOUBLE - list_max({logits})::DOUBLE))))"
        f" + list_max({logits})::DOUBLE - {logits}[{label} + 1]::DOUBLE)"
    )


LOGITS = f"""lg AS (SELECT vec_id, (vec_id // {BS})::BIGINT AS batch_id, embedding AS logits,
  (CASE WHEN vec_id % 13 = 0 THEN label ELSE -100 END)::BIGINT AS mlm_label,
  [list_sum(embedding[1:len(embedding) // 2]::DOUBLE[]), list_sum(embedding[len(embedding) // 2 + 1:]::DOUBLE[])] AS nsp_logits, (label % 2)::BIGINT AS nsp_label FROM embeddings)"""

BATCH_LOSSES = f"""bl AS (SELECT batch_id,
  avg(CASE WHEN mlm_label <> -100 THEN {_ce('logits', 'mlm_label')} END) AS mlm_loss,
  avg({_ce('nsp_logits', 'nsp_label')}) AS nsp_loss,
  count(*) FILTER (WHERE mlm_label <> -100)::BIGINT AS n_scored,
  count(*)::BIGINT AS n_rows FROM lg GROUP BY batch_id)"""


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["corpus_scan"] = "SELECT (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS row_id, text FROM documents"
    q["clean_lines"] = _with(_corpus("docs"), "SELECT row_id, text FROM lines")
    q["token_counts"] = _with(_corpus("docs") + _vocab()[:1], "SELECT token, n FROM counts")
    q["vocab_build"] = _with(_docs_stack("vocab"), "SELECT token, id, n FROM vocab")
    q["documents_segmented"] = _with(
        _docs_stack("sentences"), "SELECT doc_key, n_sents, row_id AS first_row_id FROM sents WHERE sent_idx = 0"
    )
    q["sentence_index"] = _with(_docs_stack("sentences"), "SELECT row_id, doc_key, sent_idx, n_sents FROM sents")
    q["doc_lengths"] = _with(
        _docs_stack("sentences"),
        "SELECT n_sents, count(*)::BIGINT AS n_documents FROM sents WHERE sent_idx = 0 GROUP BY n_sents",
    )
    q["corpus_totals"] = _with(
        _docs_stack("sentences"),
        f"""SELECT (SELECT v FROM vsize) AS vocab_size,
  count(*) FILTER (WHERE sent_idx = 0)::BIGINT AS n_documents,
  count(*)::BIGINT AS n_sentences,
  count(*) FILTER (WHERE sent_idx < n_sents - 1)::BIGINT AS n_examples,
  (n_examples - greatest(1, floor({_C.validation_fraction}::DOUBLE * n_examples)))::BIGINT AS n_train,
  greatest(1, floor({_C.validation_fraction}::DOUBLE * n_examples))::BIGINT AS n_val,
  CAST(ceil(n_train / {BS}.0) AS BIGINT) AS steps_per_epoch,
  CAST(ceil(n_val / {BS}.0) AS BIGINT) AS val_steps
FROM sents""",
    )
    q["token_ids"] = _with(
        _docs_stack("sentences")
        + [
            f"""ti_ex AS (SELECT row_id, generate_subscripts(tk, 1) AS pos, unnest(tk) AS token
  FROM (SELECT row_id, {_lookup_words('text')} AS tk FROM sents))""",
            """ti AS (SELECT e.row_id, count(*)::BIGINT AS n_tokens,
  string_agg(CAST(coalesce(v.id, 0) AS VARCHAR), ' ' ORDER BY e.pos) AS ids
  FROM ti_ex e LEFT JOIN vocab v ON v.token = e.token GROUP BY e.row_id)""",
        ],
        """SELECT s.row_id, coalesce(ti.n_tokens, 0)::BIGINT AS n_tokens, coalesce(ti.ids, '') AS ids
FROM sents s LEFT JOIN ti ON ti.row_id = s.row_id""",
    )
    q["vocab_cached"] = q["vocab_incremental"] = q["vocab_build"]
    q["sentence_scan"] = q["sentence_index"]
    spaced = "list_filter(string_split(text, ' '), lambda w: w <> '')"
    q["custom_split_ids"] = q["token_ids"].replace(_lookup_words("text"), spaced).replace(_words("text"), spaced)
    q["special_token_ids"] = q["token_ids"].replace(
        "sents AS (SELECT * FROM sents_all",
        "sents AS (SELECT * REPLACE ('[MASK] ([SEP]' || text || '[CLS]x [MASK [PAD].' AS text) FROM sents_all")
    q["unk_rate"] = _with(
        _docs_stack("vocab"),
        f"""SELECT count(*)::BIGINT AS n_tokens, count(*) FILTER (WHERE v.id IS NULL)::BIGINT AS n_unk,
  round(count(*) FILTER (WHERE v.id IS NULL) / count(*), 6) AS unk_rate
FROM (SELECT unnest({_words('text')}) AS token FROM lines) t LEFT JOIN vocab v ON v.token = t.token""",
    )
    q["nsp_pairs"] = _with(_docs_stack("pairs"), "SELECT example_id, b_id, is_next FROM pairs")
    q["nsp_balance"] = _with(
        _docs_stack("pairs"), "SELECT is_next, count(*)::BIGINT AS n_pairs FROM pairs GROUP BY is_next"
    )
    q["pair_truncation"] = _with(_docs_stack("examples"), "SELECT example_id, n_a, n_b FROM ex2")
    q["assembled_long"] = _with(_docs_stack("examples"), "SELECT example_id, pos, id, seg, attn FROM long")
    q["mlm_long"] = _with(
        _docs_stack("masked"), "SELECT example_id, pos, input_id, label FROM masked"
    )
    later = [part for level in _LEVELS[:5] for part in _BUILDERS[level]()]
    q["mlm_long_later"] = _with(
        _corpus("docs") + later + _masked(3), "SELECT example_id, pos, input_id, label FROM masked"
    )
    q["examples_written"] = _with(
        _corpus("docs") + later + _masked(1) + _split(),
        """SELECT b.split, b.batch_id, b.slot, m.example_id,
  string_agg(CAST(input_id AS VARCHAR), ' ' ORDER BY pos) AS input_ids,
  string_agg(CAST(attn AS VARCHAR), ' ' ORDER BY pos) AS attention_mask,
  string_agg(CAST(seg AS VARCHAR), ' ' ORDER BY pos) AS token_type_ids,
  string_agg(CAST(label AS VARCHAR), ' ' ORDER BY pos) AS labels,
  is_next AS next_sentence_label
FROM masked m JOIN batches b ON b.example_id = m.example_id
WHERE b.epoch = 1 GROUP BY b.split, b.batch_id, b.slot, m.example_id, is_next""",
    )
    q["mlm_rates"] = _with(
        _docs_stack("masked"),
        f"""SELECT count(*) FILTER (WHERE id NOT IN (1, 2, 3))::BIGINT AS n_maskable,
  count(*) FILTER (WHERE sel)::BIGINT AS n_selected,
  count(*) FILTER (WHERE sel AND br < {_C.mask_share})::BIGINT AS n_mask,
  count(*) FILTER (WHERE sel AND br >= {_C.mask_share} AND br < {round(_C.mask_share + _C.random_share, 12)})::BIGINT AS n_random,
  count(*) FILTER (WHERE sel AND br >= {round(_C.mask_share + _C.random_share, 12)})::BIGINT AS n_unchanged
FROM masked""",
    )
    q["training_examples"] = _with(_docs_stack("masked"), _training_select())
    q["example_summary"] = _with(
        _docs_stack("masked"),
        """SELECT is_next, count(DISTINCT example_id)::BIGINT AS n_examples,
  count(*) FILTER (WHERE attn = 1)::BIGINT AS real_tokens,
  count(*) FILTER (WHERE label <> -100)::BIGINT AS scored_tokens
FROM masked GROUP BY is_next""",
    )
    q["split_exact"] = _with(_docs_stack("split"), "SELECT example_id, split, split_rank FROM split")
    q["split_selected"] = _with(_docs_stack("split"), "SELECT example_id, split FROM split")
    q["split_by_document"] = _with(
        _docs_stack("split")
        + [
            "pdoc AS (SELECT doc_key, count(*)::BIGINT AS n FROM pairs GROUP BY doc_key)",
            f"""pdr AS (SELECT doc_key, coalesce(sum(n) OVER (ORDER BY {_md5('split', 'doc_key')}, doc_key
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM pdoc)""",
            """dsplit AS (SELECT p.example_id, CASE WHEN d.before < nval.n_val THEN 'val' ELSE 'train' END AS split
  FROM pairs p JOIN pdr d ON d.doc_key = p.doc_key CROSS JOIN nval)""",
        ],
        f"""SELECT example_id, split,
  (row_number() OVER (PARTITION BY split ORDER BY {_md5('split', 'example_id')}, example_id) - 1)::BIGINT AS split_rank
FROM dsplit""",
    )
    q["epoch_batches"] = _with(_docs_stack("split"), "SELECT split, epoch, batch_id, slot, example_id FROM batches")
    q["resume_tail"] = _with(
        _docs_stack("split"),
        """SELECT b.epoch, b.batch_id, b.slot, b.example_id FROM batches b CROSS JOIN spe
WHERE b.split = 'train' AND (CASE WHEN floor(spe.spe * 0.5) > 0
  THEN b.epoch > 3 OR (b.epoch = 3 AND b.batch_id >= floor(spe.spe * 0.5))
  ELSE b.epoch > 3 END)""",
    )
    q["resume_from_tag"] = _with(
        _docs_stack("split"),
        """SELECT b.split, b.epoch, b.batch_id, b.slot, b.example_id FROM batches b CROSS JOIN spe
WHERE b.epoch > 3 OR (b.epoch = 3 AND (b.split = 'val' OR b.batch_id >= floor(spe.spe * 0.5)))""",
    )
    q["batch_manifest"] = _with(
        _docs_stack("split")
        + [
            """bm_rows AS (SELECT b.epoch, b.batch_id, count(*)::BIGINT AS rows,
  sum(e.n_a + e.n_b + 3)::BIGINT AS real_tokens
  FROM batches b JOIN ex2 e ON e.example_id = b.example_id WHERE b.split = 'train' GROUP BY b.epoch, b.batch_id)""",
            f"""bm_e AS (SELECT b.epoch, b.batch_id, b.example_id, {_half(1, 'mlm', 'b.epoch', 'b.example_id')} AS k,
  {_half(9, 'mlm', 'b.epoch', 'b.example_id')} AS k2
  FROM batches b WHERE b.split = 'train')""",
            """bm_k AS (SELECT e.epoch, e.batch_id, e.k, e.k2, l.pos FROM bm_e e JOIN long l ON l.example_id = e.example_id
  WHERE l.id NOT IN (1, 2, 3))""",
            f"""bm_sc AS (SELECT epoch, batch_id, count(*) FILTER (WHERE {_draw('pos', 0)} < {P_MLM})::BIGINT AS scored
  FROM bm_k GROUP BY epoch, batch_id)""",
            f"""bm AS (SELECT r.epoch, r.batch_id, r.rows, r.real_tokens, coalesce(s.scored, 0)::BIGINT AS scored_tokens,
  (r.epoch * spe.spe + r.batch_id)::BIGINT AS global_step, (r.batch_id + 1)::BIGINT AS step_in_epoch,
  spe.spe AS spe
  FROM bm_rows r LEFT JOIN bm_sc s ON s.epoch = r.epoch AND s.batch_id = r.batch_id CROSS JOIN spe)""",
            """bm2 AS (SELECT *, CASE WHEN step_in_epoch = spe THEN '100q'
    WHEN step_in_epoch = floor(spe * 0.75) THEN '75q'
    WHEN step_in_epoch = floor(spe * 0.5) THEN '50q'
    WHEN step_in_epoch = floor(spe * 0.25) THEN '25q' END AS milestone FROM bm)""",
        ],
        f"""SELECT epoch, batch_id, rows, real_tokens, scored_tokens, global_step, step_in_epoch,
  {_lr('global_step', f'spe * {EPOCHS}')} AS lr,
  {_lr('global_step + 1', f'spe * {EPOCHS}')} AS lr_logged,
  milestone,
  '{_C.model_folder}/{_C.model_prefix}' || CAST(epoch AS VARCHAR) || '_' || milestone || '.pt' AS checkpoint_tag,
  (CASE WHEN milestone = '100q' THEN 0 WHEN milestone IS NOT NULL THEN step_in_epoch END)::BIGINT AS checkpoint_step
FROM bm2""",
    )
    q["masked_cross_entropy"] = _with(
        [LOGITS],
        f"""SELECT batch_id, round(avg(CASE WHEN mlm_label <> -100 THEN {_ce('logits', 'mlm_label')} END), 6) AS mlm_loss,
  count(*) FILTER (WHERE mlm_label <> -100)::BIGINT AS n_scored FROM lg GROUP BY batch_id""",
    )
    q["split_cross_entropy"] = q["masked_cross_entropy"]
    q["pair_loss"] = _with(
        [LOGITS],
        f"""SELECT batch_id, round(avg({_ce('nsp_logits', 'nsp_label')}), 6) AS nsp_loss, count(*)::BIGINT AS n_rows
FROM lg GROUP BY batch_id""",
    )
    q["total_loss"] = _with(
        [LOGITS, BATCH_LOSSES],
        "SELECT batch_id, round(mlm_loss + nsp_loss, 6) AS loss, round(mlm_loss, 6) AS mlm_loss, round(nsp_loss, 6) AS nsp_loss FROM bl",
    )
    q["epoch_metrics"] = _with(
        [
            """sc AS (SELECT CASE WHEN user_id % 10 = 0 THEN 'val' ELSE 'train' END AS split,
  (event_id // 100)::BIGINT AS epoch, event_type AS tag, event_id AS step, CAST(value AS DOUBLE) AS value FROM events)"""
        ],
        """SELECT split, epoch, tag, round(sum(value) / count(value), 6) AS mean_value,
  count(value)::BIGINT AS n_batches, count(*) FILTER (WHERE value IS NULL)::BIGINT AS n_missing
FROM sc GROUP BY split, epoch, tag""",
    )
    q["epoch_metrics_full_denominator"] = q["epoch_metrics"].replace("sum(value) / count(value)", "sum(value) / 100.0::DOUBLE")
    # a step of the log is one event, and so are the rows that a resumed run keeps
    q["scalar_log_resumed"] = q["epoch_metrics"]
    q["scalar_log"] = _with(
        [LOGITS, BATCH_LOSSES],
        """SELECT 'train/loss' AS tag, batch_id AS step, round(mlm_loss + nsp_loss, 6) AS value FROM bl
UNION ALL SELECT 'train/mlm_loss', batch_id, round(mlm_loss, 6) FROM bl
UNION ALL SELECT 'train/nsp_loss', batch_id, round(nsp_loss, 6) FROM bl""",
    )
    q["scalar_log_written"] = f"SELECT 'train' AS split, 0::BIGINT AS epoch, tag, step, value FROM ({q['scalar_log']}) l"
    q["lr_log"] = f"SELECT 'train/lr' AS tag, global_step AS step, lr_logged AS value FROM ({q['batch_manifest']}) m"
    q["epoch_log"] = (
        "SELECT 'epoch/' || split || '_' || tag AS tag, epoch AS step, round(sum_v / n_v, 6) AS value FROM ("
        "SELECT CASE WHEN user_id % 10 = 0 THEN 'val' ELSE 'train' END AS split, (event_id // 100)::BIGINT AS epoch,"
        " event_type AS tag, sum(CAST(value AS DOUBLE)) AS sum_v, count(value) AS n_v FROM events GROUP BY ALL) g"
    )
    q["conv_sentence_index"] = _with(
        _stack("conv", "sentences"), "SELECT row_id, doc_key, sent_idx, n_sents FROM sents"
    )
    q["conv_nsp_pairs"] = _with(_stack("conv", "pairs"), "SELECT example_id, b_id, is_next FROM pairs")
    q["conv_training_examples"] = _with(_stack("conv", "masked"), _training_select())
    return q
