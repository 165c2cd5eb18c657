"""Attributes of an employee as expressions on the roster columns.

Hire-time attributes hang on the employee number, so they stay the same in every
month; refreshed ones also hang on the month of the last refresh.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterloom.functions import pools
from rosterloom.functions.dates import on_trial, tenure_days
from rosterloom.functions.draws import (
    chance, draw, first_items, literal_array, past_date, pick, repeated, shuffle_marks, uniform_decimal, uniform_int,
    weighted, wide_draw,
)
from rosterloom.functions.scores import shortfall
from rosterloom.functions.text import by_key, latin_word, strip_leading_word
from rosterloom.operators.windows import capped_growth, counter_since

GRADE_CAP = 17
GOAL_SLOT = "{x}"


class Attributes:
    """Column builders over the columns ``emp_no, is_manager, hire_month, month_no, report_date,
    hire_report_date`` and, where named, the unit columns of :mod:`rosterloom.plans.panel`."""

    def __init__(self, seed: int):
        self.seed = seed

    def _u(self, name: str, *more: Column | str | int) -> Column:
        return draw(name, "emp_no", *more, seed=self.seed)

    def _by_flavour(self, flag: str, u: Column, it_pool, bank_pool) -> Column:
        return F.when(F.col(flag), pick(u, it_pool)).otherwise(pick(u, bank_pool))

    # -- person ---------------------------------------------------------------

    def gender(self) -> Column:
        return weighted(self._u("gender"), pools.GENDER_WEIGHTS)

    def _by_gender(self, name: str, male: list[str], female: list[str]) -> Column:
        """Pick from the male or the female pool; without a known gender, from both."""
        u, gender = self._u(name), self.gender()
        return (
            F.when(gender == "M", pick(u, male)).when(gender == "F", pick(u, female)).otherwise(pick(u, male + female))
        )

    def surname(self) -> Column:
        return self._by_gender("surname", pools.SURNAMES, [s + "а" for s in pools.SURNAMES])

    def first_name(self) -> Column:
        return self._by_gender("first_name", pools.FIRST_NAMES_MALE, pools.FIRST_NAMES_FEMALE)

    def patronymic(self) -> Column:
        stems = pools.PATRONYMIC_STEMS
        return self._by_gender("patronymic", [s + "ич" for s in stems], [s + "на" for s in stems])

    def age(self) -> Column:
        return uniform_int(self._u("age"), 22, 62).cast("int")

    def slug(self) -> Column:
        """First name and surname in Latin letters and the employee's number: no two people share an address."""

        def spelled(words: list[str]) -> list[str]:
            return [latin_word(w) for w in words]

        first = self._by_gender(
            "first_name", spelled(pools.FIRST_NAMES_MALE), spelled(pools.FIRST_NAMES_FEMALE)
        )
        last = self._by_gender("surname", spelled(pools.SURNAMES), spelled([s + "а" for s in pools.SURNAMES]))
        return F.concat(first, F.lit("."), last, F.lit("."), F.col("emp_no").cast("string"))

    def work_email(self) -> Column:
        return F.concat(self.slug(), F.lit("@" + pools.WORK_DOMAIN))

    def external_email(self) -> Column:
        number = uniform_int(self._u("mail_number"), 10, 999).cast("string")
        return F.concat(self.slug(), F.lit("."), number, F.lit("@"), pick(self._u("mail_domain"), pools.MAIL_DOMAINS))

    def phone(self) -> Column:
        number = uniform_int(self._wide("phone"), pools.PHONE_LOW, pools.PHONE_HIGH)
        return F.concat(F.lit("+7"), number.cast("string"))

    def _wide(self, name: str, *more: Column | str | int) -> Column:
        return wide_draw(name, "emp_no", *more, seed=self.seed)

    def child_count(self) -> Column:
        return F.when(self.age() >= 24, weighted(self._u("children"), pools.CHILD_COUNT_WEIGHTS)).otherwise(0)

    def children_gender(self) -> Column:
        return repeated(
            self.child_count(), lambda i: weighted(self._u("child_gender", i), pools.CHILD_GENDER_WEIGHTS)
        )

    def children_years(self) -> Column:
        oldest = F.least(F.lit(25), self.age() - F.lit(20)).cast("bigint")
        return repeated(
            self.child_count(), lambda i: uniform_int(self._u("child_years", i), 0, oldest).cast("int")
        )

    def family_status(self) -> Column:
        return weighted(self._u("family"), pools.FAMILY_WEIGHTS)

    def parental_leave(self) -> Column:
        return F.coalesce(((self.gender() == "F") & chance(self._u("parental"), 0.04)).cast("int"), F.lit(0))

    # -- education, languages, skills ----------------------------------------

    def university(self) -> Column:
        return pick(self._u("university"), pools.UNIVERSITIES)

    def speciality(self) -> Column:
        return self._by_flavour("hire_is_it", self._u("speciality"), pools.SPECIALITIES_IT, pools.SPECIALITIES_BANK)

    def education_end(self) -> Column:
        year = F.year("hire_report_date")
        low = F.greatest(F.lit(1985), year - self.age() + F.lit(20)).cast("bigint")
        chosen = uniform_int(self._u("education"), low, (year - F.lit(1)).cast("bigint"))
        return F.concat(chosen.cast("string"), F.lit("-06-30"))

    def languages(self) -> Column:
        level_u = self._u("english_level")
        english = F.concat(
            F.lit(pools.FIRST_LANGUAGE + " / "),
            F.when(F.col("hire_is_it"), weighted(level_u, pools.ENGLISH_IT_WEIGHTS)).otherwise(
                weighted(level_u, pools.ENGLISH_BANK_WEIGHTS)
            ),
        )
        speaks = F.when(F.col("hire_is_it"), chance(self._u("english"), 0.95)).otherwise(
            chance(self._u("english"), 0.7)
        )
        second = F.concat(
            pick(self._u("second_language"), pools.OTHER_LANGUAGES),
            F.lit(" / "),
            pick(self._u("second_level"), pools.OTHER_LEVELS),
        )
        none = F.array().cast("array<string>")
        return F.concat(
            F.when(speaks, F.array(english)).otherwise(none),
            F.when(chance(self._u("second"), 0.15), F.array(second)).otherwise(none),
        )

    def shuffled(self) -> dict[str, Column]:
        """Working columns: shuffled ordinals of each pool that several items are taken from."""

        def order(name: str, it_pool, bank_pool) -> Column:
            it = shuffle_marks(name, len(it_pool), "emp_no", seed=self.seed)
            bank = shuffle_marks(name, len(bank_pool), "emp_no", seed=self.seed)
            return it if len(it_pool) == len(bank_pool) else F.when(F.col("hire_is_it"), it).otherwise(bank)

        return {
            "_skill_order": order("skills", pools.SKILLS_IT, pools.SKILLS_BANK),
            "_soft_order": order("soft_skills", pools.SKILLS_SOFT, pools.SKILLS_SOFT),
            "_goal_order": order("goals", pools.GOALS_IT, pools.GOALS_BANK),
            "_goal_texts": self._goal_texts(),
            "_achievement_order": order("achievements", pools.ACHIEVEMENTS_IT, pools.ACHIEVEMENTS_BANK),
        }

    def _pool(self, it_pool, bank_pool) -> Column:
        return F.when(F.col("hire_is_it"), literal_array(it_pool)).otherwise(literal_array(bank_pool))

    def skills(self) -> Column:
        count = uniform_int(self._u("skill_count"), 3, 8)
        hard = first_items("_skill_order", self._pool(pools.SKILLS_IT, pools.SKILLS_BANK), count, most=8)
        soft_count = uniform_int(self._u("soft_count"), 1, 3)
        has_soft = F.col("is_manager") | chance(self._u("has_soft"), 0.4)
        soft = first_items(
            "_soft_order", literal_array(pools.SKILLS_SOFT), F.when(has_soft, soft_count).otherwise(0), most=3
        )
        return F.concat(hard, soft)

    # -- goals ------------------------------------------------------------------

    def goal_count(self) -> Column:
        return uniform_int(self._u("goal_count"), 2, 5)

    def _goal_texts(self) -> Column:
        """Every goal template with its own mark filled in."""

        def filled(texts: list[str]) -> Column:
            parts = [(i, *text.split(GOAL_SLOT)) for i, text in enumerate(texts)]
            return F.array(*[F.concat(F.lit(head), self._goal_mark(i), F.lit(tail)) for i, head, tail in parts])

        return F.when(F.col("hire_is_it"), filled(pools.GOALS_IT)).otherwise(filled(pools.GOALS_BANK))

    def goals(self) -> Column:
        return first_items("_goal_order", F.col("_goal_texts"), self.goal_count(), most=5)

    def _goal_mark(self, i: int) -> Column:
        number = uniform_int(self._u("goal_number", i), 5, 95).cast("string")
        kind = self._u("goal_mark", i) % F.lit(len(pools.GOAL_MARKS) + 1)
        return F.coalesce(F.get(literal_array(pools.GOAL_MARKS), kind.cast("int")), number)

    def completion(self, month: Column | None = None) -> Column:
        """Mean completion as of the last quarterly review, or at hire."""
        return uniform_decimal(self._u("completion", F.lit(0) if month is None else month), 3000, 10000, 4)

    def open_goals(self) -> Column:
        return shortfall(self.goal_count(), self.completion())

    def risked_goals(self) -> Column:
        return uniform_int(self._u("risked"), 0, self.open_goals())

    def achievements(self) -> Column:
        count = uniform_int(self._u("achievement_count"), 0, 3)
        items = self._pool(pools.ACHIEVEMENTS_IT, pools.ACHIEVEMENTS_BANK)
        return first_items("_achievement_order", items, count, most=3)

    # -- work -------------------------------------------------------------------

    def career_status(self) -> Column:
        return weighted(self._u("career"), pools.CAREER_WEIGHTS)

    def vacation_days(self) -> Column:
        return uniform_int(self._u("vacation"), 0, 28).cast("int")

    def lead_years(self) -> Column:
        most = F.least(F.lit(25), F.greatest(F.lit(1), self.age() - F.lit(25))).cast("bigint")
        as_manager = uniform_int(self._u("lead_years"), F.lit(1).cast("bigint"), most)
        before = F.when(chance(self._u("led_before"), 0.15), uniform_int(self._u("led_years"), 1, 5)).otherwise(0)
        return (
            F.when(F.col("is_manager"), as_manager).when(self.age() > 28, before).otherwise(0).cast("int")
        )

    def hire_date(self) -> Column:
        u = self._u("hire_date")
        first = past_date(F.col("hire_report_date"), u, 30, 365 * 15)
        later = past_date(F.col("hire_report_date"), u, 0, 60)
        return F.when(F.col("hire_month") == 0, first).otherwise(later)

    def tenure(self) -> Column:
        return tenure_days(F.col("report_date"), self.hire_date())

    def trial(self) -> Column:
        return on_trial(self.tenure())

    def raise_days(self) -> Column:
        """Days since the last raise: 30 a month on top of the hire value, from 0 after a raise."""
        base = uniform_int(self._u("raise_base"), 0, 900)
        start = F.greatest(F.lit(0), F.col("hire_month") - F.lit(1))
        return counter_since(base, F.col("raise_month"), F.col("month_no"), start, 30).cast("int")

    def result_grade(self) -> Column:
        return weighted(self._u("fp_res", self._review()), pools.RESULT_WEIGHTS)

    def competence_grade(self) -> Column:
        return weighted(self._u("fp_comp", self._review()), pools.COMPETENCE_WEIGHTS)

    def _review(self) -> Column:
        return F.coalesce(F.col("quarter_month"), F.lit(0))

    def current_completion(self) -> Column:
        return self.completion(self._review())

    def base_grade(self) -> Column:
        return F.when(F.col("is_manager"), uniform_int(self._u("grade"), 11, 14)).otherwise(
            uniform_int(self._u("grade"), 7, 13)
        )

    def grade(self) -> Column:
        return capped_growth(self.base_grade(), F.col("promotions"), GRADE_CAP).cast("int")

    def _title_u(self, name: str) -> Column:
        return self._u(name, F.coalesce(F.col("title_month"), F.lit(0)))

    def position(self) -> Column:
        """Managers are named after their unit; others draw a title at hire and at each job change."""
        drawn = self._by_flavour("is_it", self._title_u("position"), pools.POSITIONS_IT, pools.POSITIONS_BANK)
        return F.when(F.col("is_manager"), manager_title(F.col("unit_name"), F.col("unit_level"))).otherwise(drawn)

    def profession(self) -> Column:
        drawn = self._by_flavour("is_it", self._title_u("profession"), pools.PROFESSIONS_IT, pools.PROFESSIONS_BANK)
        return F.when(F.col("is_manager"), F.lit(pools.MANAGER_PROFESSION)).otherwise(drawn)

    def successor_count(self) -> Column:
        return uniform_int(self._u("successor_count", "month_no"), 0, 3)

    def successor_draws(self) -> list[Column]:
        return [self._wide(f"successor{i}", "month_no") for i in (1, 2, 3)]


def manager_title(unit_name: Column, level: Column) -> Column:
    bare = strip_leading_word(unit_name, pools.UNIT_WORDS)
    return F.concat_ws(" ", F.lit(pools.MANAGER_TITLE), by_key(level, pools.LEVEL_WORDS), bare)
