"""Fixed values.

These strings, lists and patterns must equal the ones the original
dataset scripts used, otherwise the produced examples differ.  They are
stated here once, in their natural order, and imported everywhere else.
"""

# --- fixed values: system prompts -------------------------------------------
PAIR_SYSTEM_PROMPT = (
    "You are a precise coding assistant that diagnoses errors step-by-step, "
    "references file paths/lines when useful, and proposes concrete fixes."
)
PATCH_SYSTEM_PROMPT = "You are a terse, patch-first coding assistant."
FIM_SYSTEM_PROMPT = (
    "You are a precise coding assistant that completes code given a prefix and suffix."
)
FIM_MARKER_SYSTEM_PROMPT = "Fill the missing code exactly; minimal changes."

# --- fixed values: patch and FIM templates ----------------------------------
PATCH_INTENT = "Commit intent: "
PATCH_FILE = "\nFile: "
PATCH_BEFORE = "\n<BEFORE>\n"
PATCH_OPEN = "```diff\n"
PATCH_CLOSE = "\n```"
PATCH_REASON = "\nReason: "
FIM_FILE = "[FILE] "
FIM_PREFIX = "PREFIX:\n"
FIM_FILL = "\n<FILL>\n...\n</FILL>\nSUFFIX:\n"

# --- fixed values: log segment types ----------------------------------------
USER_SEGMENT_TYPES = ["text", "input_text", "message", "input", "tool_result"]

# --- fixed values: tool output rendering ------------------------------------
TOOL_RESULT_PREFIX = "\n[TOOL RESULT]\n"
TOOL_FALLBACK_PREFIX = "[TOOL RESULT]\n"
TOOL_TRUNCATED_SUFFIX = "\n[...truncated tool output...]"

# --- fixed values: chat template markers ------------------------------------
IM_START = "<|im_start|>"
IM_END = "<|im_end|>"
ASSISTANT_TAG = "<|im_start|>assistant"
TOOL_MARKERS = ["<|tool|>", "<|assistant|tool_call|>", "<tool_call>"]

# --- fixed values: source-file extensions for FIM ---------------------------
CODE_EXTENSIONS = [".ts", ".tsx", ".js", ".jsx", ".py", ".sql", ".json", ".css", ".scss", ".md"]
MAX_SOURCE_CHARS = 800_000

# --- fixed values: patch path filters ---------------------------------------
SKIP_EXTENSIONS = [
    ".lock", ".min.js", ".map", ".png", ".jpg", ".jpeg", ".gif", ".webp",
    ".ico", ".svg", ".pdf", ".ttf", ".otf", ".woff", ".woff2", ".zip", ".gz",
    ".bz2", ".7z", ".dylib", ".so", ".dll", ".exe", ".bin",
]
SKIP_DIRS = [
    "node_modules", "dist", "build", ".next", ".turbo", ".git", "out", "coverage",
    ".venv", "venv", "__pycache__", ".cache",
]
VENDOR_FILE_PATTERN = (
    r"(package-lock\.json|pnpm-lock\.yaml|yarn\.lock|Cargo\.lock|Podfile\.lock"
    r"|go\.sum|poetry\.lock|Gemfile\.lock)$"
)

# --- fixed values: commit message intent ------------------------------------
INTENT_PATTERN = (
    r"(fix|add|update|refactor|clean|handle|guard|support|implement|remove|rename"
    r"|migrate|speed|perf|docs?)"
)
BORING_PATTERN = r"\b(WIP|bump|chore|merge|format|fmt|prettier)\b"

# --- fixed values: FIM prompt -------------------------------------------------
FIM_INSTRUCTION = (
    "Fill in the missing code between <FILL> and </FILL>. "
    "Preserve formatting and indentation. Respond with code only.\n\n"
)

# --- defaults of the original command lines ----------------------------------
DEFAULT_MIN_USER_CHARS = 80
DEFAULT_MAX_TOKENS = 4096
DEFAULT_PAIR_TOOL_CHARS = 6000
DEFAULT_FOLLOW_TOOL_CHARS = 4000
DEFAULT_FOLLOW_K = 50
DEFAULT_EVAL_FRAC = 0.15
DEFAULT_MIN_EVAL = 100
DEFAULT_SEED = 42
DEFAULT_FIM_PER_FILE = 6
DEFAULT_FIM_MAX_LEN = 1600

# Python's str.isspace() set, written as a Java regex character class:
# Unicode White_Space plus the four information separators U+001C..U+001F.
JAVA_SPACE_CLASS = r"[\s\x1c-\x1f]"
# The same set for RE2 (DuckDB oracles), spelled out.
RE2_SPACE_CLASS = (
    r"[\s\x0b\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]"
)
