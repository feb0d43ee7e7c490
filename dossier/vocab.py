"""Versioned vocabularies: source reliability, skills, countries. Every table can be overridden.

The values below are fixed: results depend on them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace
from pathlib import Path

VERSION = "2026.06.1"

# Weight of a source type for a field; "_default" for fields that are not listed.
RELIABILITY = {
    "recruiter_csv": {"_default": 0.80, "full_name": 0.80, "emails": 0.85, "phones": 0.85, "headline": 0.60, "location.city": 0.70, "location.region": 0.70, "location.country": 0.75, "experience": 0.75, "years_experience": 0.55, "skills": 0.55},
    "ats_json": {"_default": 0.82, "full_name": 0.78, "emails": 0.88, "phones": 0.82, "headline": 0.70, "location.city": 0.72, "location.region": 0.72, "location.country": 0.75, "experience": 0.80, "education": 0.80, "skills": 0.70, "years_experience": 0.70},
    "github": {"_default": 0.60, "full_name": 0.55, "emails": 0.60, "headline": 0.50, "location.city": 0.45, "location.region": 0.45, "location.country": 0.45, "links.github": 0.98, "links.portfolio": 0.70, "skills": 0.70},
    "resume": {"_default": 0.72, "full_name": 0.70, "emails": 0.75, "phones": 0.75, "headline": 0.65, "location.city": 0.65, "location.region": 0.65, "location.country": 0.75, "experience": 0.82, "education": 0.82, "skills": 0.80, "years_experience": 0.65, "links.linkedin": 0.80, "links.github": 0.80, "links.portfolio": 0.80},
    "recruiter_notes": {"_default": 0.30, "full_name": 0.30, "emails": 0.40, "phones": 0.40, "headline": 0.30, "location.city": 0.30, "location.region": 0.30, "location.country": 0.30, "skills": 0.40, "experience": 0.30},
}
RELIABILITY_DEFAULT = 0.5

# Canonical skill and its aliases.
SKILLS = {
    "Python": ["python", "python3", "py", "python 3"],
    "JavaScript": ["javascript", "js", "node", "nodejs", "node.js", "ecmascript"],
    "TypeScript": ["typescript", "ts"],
    "Java": ["java", "core java"],
    "C++": ["c++", "cpp", "cplusplus"],
    "C": ["c lang", "c language"],
    "C#": ["c#", "csharp", "c sharp"],
    "Go": ["go", "golang"],
    "Rust": ["rust", "rust-lang"],
    "Ruby": ["ruby"],
    "PHP": ["php"],
    "Swift": ["swift"],
    "Kotlin": ["kotlin"],
    "Scala": ["scala"],
    "R": ["r lang", "r language"],
    "SQL": ["sql", "structured query language"],
    "PostgreSQL": ["postgresql", "postgres", "psql"],
    "MySQL": ["mysql"],
    "MongoDB": ["mongodb", "mongo"],
    "Redis": ["redis"],
    "Elasticsearch": ["elasticsearch", "elastic search", "es"],
    "React": ["react", "react.js", "reactjs"],
    "Angular": ["angular", "angularjs"],
    "Vue.js": ["vue", "vue.js", "vuejs"],
    "Django": ["django"],
    "Flask": ["flask"],
    "FastAPI": ["fastapi", "fast api"],
    "Spring": ["spring", "spring boot", "springboot"],
    "Node.js Runtime": ["node runtime"],
    "Docker": ["docker"],
    "Kubernetes": ["kubernetes", "k8s"],
    "AWS": ["aws", "amazon web services"],
    "Google Cloud": ["gcp", "google cloud", "google cloud platform"],
    "Azure": ["azure", "microsoft azure"],
    "Terraform": ["terraform"],
    "Kafka": ["kafka", "apache kafka"],
    "Spark": ["spark", "apache spark"],
    "Hadoop": ["hadoop"],
    "TensorFlow": ["tensorflow", "tf"],
    "PyTorch": ["pytorch", "torch"],
    "scikit-learn": ["scikit-learn", "sklearn", "scikit learn"],
    "Pandas": ["pandas"],
    "NumPy": ["numpy"],
    "Machine Learning": ["machine learning", "ml"],
    "Deep Learning": ["deep learning", "dl"],
    "Natural Language Processing": ["natural language processing", "nlp"],
    "Data Engineering": ["data engineering"],
    "Distributed Systems": ["distributed systems"],
    "Microservices": ["microservices", "micro services"],
    "GraphQL": ["graphql", "graph ql"],
    "REST APIs": ["rest", "rest api", "rest apis", "restful"],
    "Git": ["git"],
    "Linux": ["linux"],
    "CI/CD": ["ci/cd", "cicd", "ci cd", "continuous integration"],
}
FUZZY_SKILL = 0.9

# Country aliases, known codes, calling codes, codes whose national numbers have a trunk 0.
COUNTRY_ALIASES = {
    "us": "US", "usa": "US", "u.s.": "US", "u.s.a.": "US", "united states": "US", "united states of america": "US", "america": "US",
    "uk": "GB", "u.k.": "GB", "united kingdom": "GB", "great britain": "GB", "britain": "GB", "england": "GB", "scotland": "GB", "wales": "GB",
    "india": "IN", "bharat": "IN", "germany": "DE", "deutschland": "DE", "france": "FR", "canada": "CA", "australia": "AU", "ireland": "IE",
    "netherlands": "NL", "the netherlands": "NL", "holland": "NL", "spain": "ES", "espana": "ES", "italy": "IT", "japan": "JP", "china": "CN",
    "brazil": "BR", "brasil": "BR", "mexico": "MX", "singapore": "SG", "switzerland": "CH", "sweden": "SE", "poland": "PL", "israel": "IL",
    "uae": "AE", "united arab emirates": "AE",
}
ISO_COUNTRIES = ["US", "GB", "IN", "DE", "FR", "CA", "AU", "IE", "NL", "ES", "IT", "JP", "CN", "BR", "MX", "SG", "CH", "SE", "PL", "IL", "AE"]
CALLING_CODES = {"US": "1", "CA": "1", "GB": "44", "IN": "91", "DE": "49", "FR": "33", "AU": "61", "IE": "353", "NL": "31", "ES": "34", "IT": "39", "JP": "81", "CN": "86", "BR": "55", "MX": "52", "SG": "65", "CH": "41", "SE": "46", "PL": "48", "IL": "972", "AE": "971"}
TRUNK_ZERO = ["44", "91", "33", "49", "61"]

# Weight of a field in the overall confidence; fields of which a tie gives no value.
IMPORTANCE = {"full_name": 3.0, "emails": 3.0, "phones": 2.0, "location.country": 1.5, "headline": 1.0, "years_experience": 1.0, "skills": 2.0, "experience": 2.0, "education": 1.5, "links.linkedin": 1.0, "links.github": 1.0}
HIGH_STAKES = ["full_name", "emails", "phones", "location.country", "links.linkedin", "links.github"]


@dataclass(frozen=True)
class Vocabulary:
    """All tables of one run."""

    reliability: dict = field(default_factory=lambda: RELIABILITY)
    reliability_default: float = RELIABILITY_DEFAULT
    skills: dict = field(default_factory=lambda: SKILLS)
    fuzzy_skill: float = FUZZY_SKILL
    country_aliases: dict = field(default_factory=lambda: COUNTRY_ALIASES)
    iso_countries: list = field(default_factory=lambda: ISO_COUNTRIES)
    calling_codes: dict = field(default_factory=lambda: CALLING_CODES)
    version: str = VERSION

    @classmethod
    def load(cls, path: str | None = None) -> Vocabulary:
        """The built-in tables, with those in a JSON file in their place."""
        return replace(cls(), **json.loads(Path(path).read_text(encoding="utf-8"))) if path else cls()

    def versions(self) -> dict[str, str]:
        return {"reliability_matrix": self.version, "skills_vocab": self.version, "country_alias": self.version}

    def weight(self, source_type: str, path: str) -> float:
        """Reliability of a source type for a field: of the field, else of the part before its dot, else of the type, else the default."""
        table = self.reliability.get(source_type)
        if table is None:
            return float(self.reliability_default)
        for name in (path, path.split(".", 1)[0], "_default"):
            if name in table:
                return float(table[name])
        return float(self.reliability_default)

    def skill_index(self) -> dict[str, str]:
        """Alias (folded) -> canonical skill."""
        found: dict[str, str] = {}
        for name, aliases in self.skills.items():
            found |= {a.casefold(): name for a in (name, *aliases)}
        return found
