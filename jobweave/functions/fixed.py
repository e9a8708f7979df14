"""Word lists, patterns and constants that results depend on."""

from __future__ import annotations

# Default skill vocabulary.
DEFAULT_SKILLS = [
    "python", "java", "c++", "javascript", "sql", "nosql", "mongodb", "react", "angular", "vue",
    "machine learning", "deep learning", "natural language processing", "nlp", "data analysis",
    "data science", "statistics", "computer vision", "artificial intelligence", "ai",
    "tensorflow", "pytorch", "keras", "scikit-learn", "pandas", "numpy", "matplotlib", "seaborn",
    "aws", "azure", "google cloud", "gcp", "docker", "kubernetes", "git", "agile", "scrum",
    "project management", "communication", "teamwork", "problem solving", "leadership",
    "html", "css", "django", "flask", "spring", "api", "restful services", "microservices",
    "big data", "hadoop", "spark", "data visualization", "tableau", "power bi", "excel",
]

# ASCII punctuation removed by cleaning. The hyphen is kept.
REMOVED_PUNCTUATION = "!\"#$%&'()*+,./:;<=>?@[\\]^_`{|}~"

# Patterns.
WHITESPACE_PATTERN = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"
EMAIL_PATTERN = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
PHONE_PATTERN = (
    r"\b(?:\+?1[ -]?)?(?:\(?([2-9][0-8][0-9])\)?[-.●\s]?)?([2-9][0-9]{2})[-.●\s]?([0-9]{4})"
    r"(?:\s*(?:#|x\.?|ext\.?|extension)\s*(\d+))?\b"
)
WORD_CHARACTER = r"\p{L}\p{N}_"

# Entity labels.
ENTITY_LABELS = ["PERSON", "ORG", "GPE", "LOC", "DATE", "MONEY", "PRODUCT"]

# Experience level to years.
EXPERIENCE_YEARS = {"Entry": 1, "Mid": 3, "Senior": 5, "Lead": 7, "Unknown": 2}
EXPERIENCE_DEFAULT = 2

# Match score weights.
MATCH_WEIGHTS = {"keyword": 0.2, "cosine": 0.5, "learned": 0.3}

# Salary rule.
SALARY_BASE = 40000.0
SALARY_PER_YEAR = 10000.0
SALARY_PER_SKILL = 2000.0
SALARY_CLOUD_SKILLS = ["aws", "cloud"]
SALARY_CLOUD_BONUS = 5000.0
SALARY_PYTHON_SKILLS = ["python"]
SALARY_PYTHON_BONUS = 3000.0
SALARY_CITY = "Francisco"
SALARY_CITY_FACTOR = 1.2
SALARY_LOW = 0.9
SALARY_HIGH = 1.1
SALARY_CURRENCY = "USD"

# Sizes.
PREVIEW_CHARS = 200
UPLOAD_PREVIEW_CHARS = 500
EMBEDDING_DIM = 384
