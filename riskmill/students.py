"""Table specification of the student dropout dataset.

All names, classes, ranges and defaults below are fixed values of that dataset.
"""

from __future__ import annotations

from riskmill.spec import FeatureRoles, FieldRule, Scenario, TableSpec

# Column groups, in file order within each group.
CATEGORICAL = ("EstadoCivil", "Curso", "QualificacaoAnterior", "Nacionalidade", "Genero")
BINARY = ("NecessidadesEspeciais", "Devedor", "MensalidadesEmDia", "Bolsista", "International")
FINANCIAL = ("Devedor", "MensalidadesEmDia")
ADMISSION = ("NotaAdmissao", "QualificacaoAnteriorGrau")
UNIT_MEASURES = ("Creditado", "Inscrito", "Avaliacoes", "Aprovado", "Grau", "SemAvaliacoes")
MACRO = ("TaxaDesemprego", "TaxaInflacao", "PIB")
TARGET = "Target"


def units(semester: int, measure: str) -> str:
    """Name of a curricular-units column, for example of the first semester's grade."""
    return f"UnidadesCurriculares{semester}Semestre{measure}"


SEMESTER_1 = tuple(units(1, measure) for measure in UNIT_MEASURES)
SEMESTER_2 = tuple(units(2, measure) for measure in UNIT_MEASURES)

# Column order of the raw table.
COLUMNS = (
    "EstadoCivil",
    "Curso",
    "QualificacaoAnterior",
    "QualificacaoAnteriorGrau",
    "Nacionalidade",
    "NotaAdmissao",
    "NecessidadesEspeciais",
    "Devedor",
    "MensalidadesEmDia",
    "Genero",
    "Bolsista",
    "International",
    *SEMESTER_1,
    *SEMESTER_2,
    *MACRO,
    TARGET,
)

ROLES = FeatureRoles(
    enrolled_1=units(1, "Inscrito"),
    approved_1=units(1, "Aprovado"),
    evaluations_1=units(1, "Avaliacoes"),
    grade_1=units(1, "Grau"),
    no_evaluation_1=units(1, "SemAvaliacoes"),
    enrolled_2=units(2, "Inscrito"),
    approved_2=units(2, "Aprovado"),
    grade_2=units(2, "Grau"),
    no_evaluation_2=units(2, "SemAvaliacoes"),
)

EARLY = Scenario(
    "early_warning",
    "Early Warning",
    CATEGORICAL + BINARY + ADMISSION + SEMESTER_1 + MACRO + ROLES.first_period,
)
FULL = Scenario("full", "Completo", EARLY.columns + SEMESTER_2 + ROLES.second_period)
SCENARIOS = {
    scenario.key: scenario
    for scenario in (
        EARLY,
        FULL,
        EARLY.without("early_warning_no_financial", "Early Warning sem financeiras", FINANCIAL),
        EARLY.without("early_warning_no_macro", "Early Warning sem macro", MACRO),
        FULL.without("full_no_macro", "Completo sem macro", MACRO),
    )
}

# Kind, default, group, lowest and highest value per column.
RULES = {
    rule.column: rule
    for rule in (
        FieldRule("EstadoCivil", "categorical", "Solteiro", "Cadastro"),
        FieldRule("Genero", "categorical", "Feminino", "Cadastro"),
        FieldRule("Nacionalidade", "categorical", "Português", "Cadastro"),
        FieldRule("Curso", "categorical", "Enfermagem", "Cadastro"),
        FieldRule("QualificacaoAnterior", "categorical", "Ensino Secundário", "Cadastro"),
        FieldRule("NecessidadesEspeciais", "binary", 0, "Cadastro"),
        FieldRule("International", "binary", 0, "Cadastro"),
        FieldRule("Devedor", "binary", 0, "Financeiro"),
        FieldRule("MensalidadesEmDia", "binary", 1, "Financeiro"),
        FieldRule("Bolsista", "binary", 0, "Financeiro"),
        FieldRule("NotaAdmissao", "numeric", 127.0, "Ingresso", 95.0, 190.0),
        FieldRule("QualificacaoAnteriorGrau", "numeric", 133.0, "Ingresso", 95.0, 190.0),
        FieldRule(units(1, "Creditado"), "numeric", 0.0, "1º semestre", 0.0, 20.0),
        FieldRule(units(1, "Inscrito"), "numeric", 6.0, "1º semestre", 0.0, 26.0),
        FieldRule(units(1, "Avaliacoes"), "numeric", 8.0, "1º semestre", 0.0, 45.0),
        FieldRule(units(1, "Aprovado"), "numeric", 5.0, "1º semestre", 0.0, 26.0),
        FieldRule(units(1, "Grau"), "numeric", 12.5, "1º semestre", 0.0, 20.0),
        FieldRule(units(1, "SemAvaliacoes"), "numeric", 0.0, "1º semestre", 0.0, 12.0),
        FieldRule(units(2, "Creditado"), "numeric", 0.0, "2º semestre", 0.0, 19.0),
        FieldRule(units(2, "Inscrito"), "numeric", 6.0, "2º semestre", 0.0, 23.0),
        FieldRule(units(2, "Avaliacoes"), "numeric", 8.0, "2º semestre", 0.0, 33.0),
        FieldRule(units(2, "Aprovado"), "numeric", 5.0, "2º semestre", 0.0, 20.0),
        FieldRule(units(2, "Grau"), "numeric", 12.5, "2º semestre", 0.0, 20.0),
        FieldRule(units(2, "SemAvaliacoes"), "numeric", 0.0, "2º semestre", 0.0, 12.0),
        FieldRule("TaxaDesemprego", "numeric", 12.7, "Macroeconomia", 7.6, 16.2),
        FieldRule("TaxaInflacao", "numeric", 0.5, "Macroeconomia", -0.8, 3.7),
        FieldRule("PIB", "numeric", 1.74, "Macroeconomia", -4.06, 3.51),
    )
}

# Category options used where the data show none.
OPTIONS = {
    "EstadoCivil": (
        "Casado",
        "Divorciado",
        "Separado Judicialmente",
        "Solteiro",
        "União de Fato",
        "Viúvo",
    ),
    "Genero": ("Feminino", "Masculino"),
    "QualificacaoAnterior": (
        "Curso de Especialização Tecnológica",
        "Curso Técnico Superior Profissional",
        "Ensino Básico (3º Ciclo)",
        "Ensino Secundário",
        "Ensino Superior - Licenciatura",
        "Outro - 11º Ano de Escolaridade",
    ),
    "Nacionalidade": ("Português",),
    "Curso": (
        "Agronomia",
        "Design de Animação e Multimédia",
        "Design de Comunicação",
        "Enfermagem",
        "Enfermagem Veterinária",
        "Engenharia Informática",
        "Ensino Básico",
        "Equincultura",
        "Gestão",
        "Higiene Oral",
        "Jornalismo e Comunicação",
        "Serviço Social",
        "Turismo",
    ),
}

TYPES = {
    **{column: "string" for column in (*CATEGORICAL, TARGET)},
    **{column: "int" for column in BINARY},
    **{
        units(semester, measure): "bigint"
        for semester in (1, 2)
        for measure in UNIT_MEASURES
        if measure != "Grau"
    },
}

STUDENTS = TableSpec(
    columns=COLUMNS,
    categorical=CATEGORICAL,
    binary=BINARY,
    target=TARGET,
    positive="Desistente",
    negative="Graduado",
    ambiguous="Matriculado",
    grades={units(1, "Grau"): units(1, "Aprovado"), units(2, "Grau"): units(2, "Aprovado")},
    roles=ROLES,
    scenarios=SCENARIOS,
    rules=RULES,
    options=OPTIONS,
    types=TYPES,
)
