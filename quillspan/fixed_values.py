"""Values that results depend on and that therefore must not be changed.

They are agreed constants of the data format (patterns, word lists, limits,
identifiers), kept together and in their natural order.  Everything else in the
library is parameterised through them.
"""

# --- fixed values: command fences and sentinels -----------------------------------
COMMAND_FENCE = r"```(?:bash|sh|shell)?[ \t]*\n(.*?)```"
SUBMIT = r"\b(?:COMPLETE_TASK_AND_SUBMIT_FINAL_OUTPUT|SUBMIT_TASK_[0-9A-F]{8}|FINALIZE_AND_SUBMIT_TASK_OUTPUT)\b"

# --- fixed values: event patterns ---------------------------------------------------
EDIT = (
    r"sed\s+-i|tee\s+[\w./-]|cat\s*>|str_replace|git apply|patch\s+-p|applypatch|cp\s+[\w./-]|mv\s+[\w./-]|"
    r"(?<![-\d&])>>?\s*(?!/dev/)[\w.][\w./-]*"
)
VERIFY = (
    r"\b(?:pytest|python\s+-c|python3\s+-c|cargo\s+test|go\s+test|npm\s+test|unittest|nosetests|rake\s+test)\b"
)
CLAIM = r"\b(?:pytest|python\s+-c|python3\s+-c|cargo\s+test|go\s+test|npm\s+test)\b"
WIDE_SEARCH = r"^\s*(?:find\s+\.|find\s+/\s|grep\s+-[a-zA-Z]*r[a-zA-Z]*\s|rg\s+.*\s+\.|grep\s+-rn\s)"
INFRA = (
    r"\b(?:pip3?\s+install\b[^\n]*\bpytest\b|python3?\s+-m\s+pip\s+install[^\n]*\bpytest\b|which\s+pytest|"
    r"find\s+/\s+-name\s+[\"']pytest[\"'])\b"
)

# --- fixed values: limits -----------------------------------------------------------
MAX_PREFIX_CHARS = 54_000
MAX_RUN = 4
DUP_RATIO = 0.5
WIDE_SEARCH_LIMIT = 3
INFRA_LIMIT = 2
DEFAULT_HORIZON = 12
OBSERVATION_CHARS = 160
HELD_OUT_ROWS = 40
MIN_ROWS_FOR_SPLIT = 80
KEEP_BAR = 250
TICKET_BAR = 150
IGNORE_LABEL = -100

# --- fixed values: sources, phases and their shares ---------------------------------
SOURCES = ("mini-coder", "open-swe-traces", "swe-hero", "mini-coder-rs")
PR_ONLY_SOURCES = ("open-swe-traces", "swe-hero")
RUST_SOURCES = ("mini-coder-rs",)
PYTHON_SOURCES = ("mini-coder", "swe-hero")
PHASES = ("cold", "pre_edit", "at_edit")
OVERFIT_PHASE_SHARES = (("cold", 55), ("pre_edit", 25), ("at_edit", 20))
OVERFIT_SOURCE_SHARES = (
    ("mini-coder", 57),
    ("open-swe-traces", 37),
    ("swe-hero", 4),
    ("mini-coder-rs", 2),
)
EVAL_PHASE_SHARES = (("cold", 65), ("pre_edit", 15), ("at_edit", 20))
REPO_CAPS = (("eval", 2), ("overfit", 8))
HORIZONS = (12, 16)

# --- fixed values: instances known to be part of an evaluation set ------------------
LEAKED_INSTANCES = (
    ("mini-coder", "modin-project__modin.8c7799fd.pr_7434"),
    ("mini-coder", "scrapy__scrapy.35212ec5.pr_6671"),
    ("open-swe-traces", "agronholm__anyio-935"),
    ("open-swe-traces", "astropy__ccdproc-901"),
    ("open-swe-traces", "beeware__briefcase-2302"),
    ("open-swe-traces", "beeware__briefcase-2401"),
    ("open-swe-traces", "conan-io__conan-18327"),
    ("open-swe-traces", "conan-io__conan-18444"),
    ("open-swe-traces", "ethereum__web3.py-3690"),
    ("open-swe-traces", "geopandas__geopandas-3591"),
    ("open-swe-traces", "matthewwithanm__python-markdownify-230"),
    ("open-swe-traces", "pdm-project__pdm-3575"),
    ("open-swe-traces", "pydata__sparse-870"),
)

# --- fixed values: scripted assistant turns -----------------------------------------
SCRIPTED_EDIT_COMMAND = "sed -i 's/return 0/return a + b/' src/math.py"
SCRIPTED_CHECK_COMMAND = "python -c 'from src.math import add; print(add(1,2))'"
SCRIPTED_SUBMIT_COMMAND = "echo COMPLETE_TASK_AND_SUBMIT_FINAL_OUTPUT"
SCRIPTED_SEARCH_COMMAND = "grep -n add src/math.py"

# --- fixed values: what reports say ---------------------------------------------------
PASS_IF = {
    "cold_verify_rate": "up vs baseline",
    "cold_edit_rate": "flat (must not drop)",
    "pre_edit_no_wide": "up",
    "pre_edit_edit_rate": "up",
    "loop_rate": "near 0",
}
SFT_RECIPE = {
    "mask": "messages[0:n_prefix] — no loss",
    "loss": "assistant turns after n_prefix",
    "lora": {"targets": "attn + shared expert", "not": "all 256 experts"},
    "lr": 5e-6,
    "epochs": 1,
    "notes": "one-third epoch if cold edit rate starts falling",
}
DPO_RECIPE = {
    "prompt": "prefix",
    "chosen": "keep continuation",
    "rejected": "drop continuation",
    "beta": 0.2,
    "lr": 5e-6,
    "epochs": 1,
}
DO_NOT = (
    "train embeddings, the output head or layer norms",
    "edit the base model's tokenizer or chat template",
    "train on a whole source instead of the rows packed from it",
)
