"""Containers for the node and edge tables."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Graph:
    """Node tables keyed as noted and edge tables unique on their end points."""

    learner: DataFrame  # hashed_email
    country: DataFrame  # code
    city: DataFrame  # id
    skill: DataFrame  # id
    program: DataFrame  # id (cohort code)
    company: DataFrame  # id
    has_skill: DataFrame  # learner, skill_id
    enrolled_in: DataFrame  # learner, program_id
    works_for: DataFrame  # learner, company_id
    has_learning_state: DataFrame | None = None  # learner, state, valid_from
    has_professional_status: DataFrame | None = None  # learner, status, valid_from

    def nodes(self) -> dict[str, DataFrame]:
        names = {
            "Learner": self.learner, "Country": self.country, "City": self.city, "Skill": self.skill,
            "Program": self.program, "Company": self.company,
        }
        return names

    def relationships(self) -> dict[str, DataFrame]:
        out = {"HAS_SKILL": self.has_skill, "ENROLLED_IN": self.enrolled_in, "WORKS_FOR": self.works_for}
        if self.has_learning_state is not None:
            out["HAS_LEARNING_STATE"] = self.has_learning_state
        if self.has_professional_status is not None:
            out["HAS_PROFESSIONAL_STATUS"] = self.has_professional_status
        return out

    def members(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self) if getattr(self, f.name) is not None}
