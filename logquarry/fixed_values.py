"""Thresholds, word lists and texts that results depend on.

Every operator takes these as parameters; this module only supplies the defaults.
"""

# --- Fixed values: reading raw logs ------------------------------------------------------

# Cell texts that the usual CSV readers treat as missing.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Characters that count as white space at the ends of a text.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# --- Fixed values: cleaned log table -----------------------------------------------------

CRITICAL_COLUMNS = ["eventtime", "eventname"]
USER_ID_COLUMNS = ["useridentityaccountid", "useridentityusername"]
CLEANED_COLUMNS = ["timestamp", "user_hash", "event", "resource", "hour", "day_of_week", "is_weekend"]
CLEANED_OPTIONAL_COLUMNS = [
    "masked_ip", "errorcode", "errormessage", "useragent", "requestparameters", "responseelements",
    "eventsource",
]

COLUMN_ALIASES = {
    "timestamp": ["timestamp", "eventtime", "time"],
    "user_hash": ["user_hash", "hashed_user", "user"],
    "event": ["event", "eventname"],
    "resource": ["resource", "resourceid"],
    "hour": ["hour"],
    "hora_completa": ["hora_completa"],
    "day_of_week": ["day_of_week", "weekday"],
    "is_weekend": ["is_weekend", "weekend"],
}

# --- Fixed values: per-minute marts ------------------------------------------------------

UNIT_COST = 0.000004
OFF_HOURS = [0, 1, 2, 3, 4, 5, 23]
RISK_THRESHOLD = 2.5
RISK_HIGH = "alto"
RISK_NORMAL = "normal"

# First matching rule wins; the prefixes are case-sensitive.
SERVICE_RULES = [
    ("ec2", ["Describe", "Run", "Start", "Stop", "Terminate"]),
    ("s3", ["GetBucket", "PutBucket", "GetObject", "PutObject", "List"]),
    ("iam", ["GetUser", "GetRole", "GetPolicy", "CreateUser", "Attach"]),
]
OTHER_SERVICE = "other_services"
SERVICES = ["ec2", "iam", "other_services", "s3"]

# --- Fixed values: weak labels and features ----------------------------------------------

PERFORMANCE_ALERT_WORDS = ["crescimento_abrupto", "degradado", "pico", "anômalo", "anomalo"]
RISK_ALERT_WORDS = ["medio", "médio", "alto", "critico", "crítico"]
RARE_EVENTS_THRESHOLD = 5.0
LEAKAGE_COLUMNS = [
    "performance_status", "is_peak", "risk_level", "reason", "is_unusual_access", "anomaly_score",
    "requests_zscore", "perf_anomaly", "sec_anomaly",
]

# --- Fixed values: models ----------------------------------------------------------------

TEST_SIZE = 0.2
SEED = 42
CONTAMINATION_RANGE = (0.01, 0.3)
ISOLATION_TREES = 300
ISOLATION_SAMPLE = 256
SUPERVISED_PROBLEM = "binary_classification_with_weak_labels"
UNSUPERVISED_PROBLEM = "unsupervised_anomaly_detection"

# --- Fixed values: questions -------------------------------------------------------------

# Matched in this order against the folded question.
INTENT_RULES = [
    ("identity", ["quem e voce", "quem voce e"]),
    ("models_metrics", ["modelo treinado", "modelos treinados", "modelos foram treinados", "metrica"]),
    ("preprocessing", ["pre processamento", "pre-processamento"]),
    ("documentation_bronze", ["bronze", "ingest"]),
    ("documentation_silver", ["silver"]),
    ("documentation_gold", ["gold"]),
    ("documentation_pipeline", ["pipeline", "camada", "processamento", "processo"]),
    ("security", ["seguranca", "risco", "alerta", "acesso fora"]),
    ("cost", ["custo", "cost", "servico mais caro"]),
    ("performance", ["performance", "desempenho", "trafego", "usuarios unicos"]),
]
DEFAULT_INTENT = "general"

INTENT_DOMAINS = {
    "identity": ["documentation_project"],
    "models_metrics": ["documentation_project"],
    "preprocessing": ["documentation_project"],
    "documentation_bronze": ["documentation_bronze"],
    "documentation_silver": ["documentation_silver"],
    "documentation_gold": [
        "documentation_gold_cost", "documentation_gold_performance", "documentation_gold_security",
    ],
    "documentation_pipeline": [
        "documentation_bronze", "documentation_silver", "documentation_gold_cost",
        "documentation_gold_performance", "documentation_gold_security",
    ],
}
MART_INTENTS = ["security", "cost", "performance"]
PROJECT_DOMAIN = "documentation_project"
TOP_K = 5

SECTION_MARKERS = {
    "identity": ["## Quem e o assistente"],
    "models_metrics": ["## Modelos treinados", "## Metricas utilizadas"],
    "preprocessing": ["## Pre-processamento dos dados"],
}

# (answer key, groups of terms): every group needs at least one of its terms in the question.
FAQ_RULES = [
    ("identity", [["quem e voce", "quem voce e"]]),
    (
        "models_metrics",
        [["modelo treinado", "modelos treinados", "modelo foi treinado", "modelos foram treinados"], ["metrica"]],
    ),
    ("preprocessing", [["pre processamento", "pre-processamento"]]),
]
HIDDEN_SOURCE_TERMS = ["quem e voce", "quem voce e"]

# --- Fixed values: prompt texts ----------------------------------------------------------

PROMPT_INSTRUCTIONS = [
    "Use as informações abaixo para responder à pergunta de forma objetiva e precisa.",
    "Não invente respostas além do contexto retornado.",
    "Quando não souber a resposta, diga que não sabe.",
]
PROMPT_PROJECT_INSTRUCTIONS = [
    "Esta e uma pergunta explicativa sobre o projeto.",
    "Responda diretamente com paragrafos ou listas curtas.",
    "Nao use os campos Conclusao e Evidencias.",
]
PROMPT_PREPROCESSING_INSTRUCTION = (
    "Sua resposta deve conter quatro topicos obrigatorios: Bronze, Silver, Gold e Treinamento de machine "
    "learning. Nao omita nenhum deles."
)
PROMPT_PREPROCESSING_TERMS = ["pre processamento", "pre-processamento"]
PROMPT_CONTEXT_HEADER = "\nContexto disponivel:"
PROMPT_QUESTION_HEADER = "Pergunta:"
PROMPT_TRAILER = "\nResposta final:"

CONTEXT_REPLACEMENTS = [
    ("Acesso fora do horário normal: False.", "Nao houve acesso fora do horario normal."),
    ("Acesso fora do horario normal: False.", "Nao houve acesso fora do horario normal."),
    ("Acesso fora do horário normal: True.", "Houve acesso fora do horario normal."),
    ("Acesso fora do horario normal: True.", "Houve acesso fora do horario normal."),
    ("Nível de risco: normal.", "Nivel de risco: normal."),
    ("NÃ\xadvel de risco: normal.", "Nivel de risco: normal."),
]
GENERIC_PHRASES = [
    "Portanto, não é necessário tomar medidas de emergência ou alarmes.",
    "Portanto, nao e necessario tomar medidas de emergencia ou alarmes.",
    "Não é necessário tomar medidas de emergência ou alarmes.",
    "Nao e necessario tomar medidas de emergencia ou alarmes.",
]
CONTEXT_RECORD = "Registro {rank}: dominio={domain}\n{text}\n"
HIT_LIST_HEADER = "=== Documentos Recuperados ==="
HIT_LIST_ENTRY = "- id={id} domain={domain} distancia_vetorial={score}\n  texto={text}"

# --- Fixed values: corpus ----------------------------------------------------------------

CHUNK_CHARS = 3000
CORPUS_TAIL = 1500
VECTOR_DIM = 768

SENTENCES = {
    "cost": (
        "No dia {date} as {hora_completa}, o servico {service} recebeu {requests} requisicoes, com um custo "
        "estimado de ${cost}."
    ),
    "performance": (
        "Em {date} as {hora_completa}, o sistema processou {requests} eventos de {unique_users} usuarios unicos."
    ),
    "security": (
        "Alerta de seguranca: Em {date} as {hora_completa}, o usuario {user_hash} gerou {requests} requisicoes. "
        "Nivel de risco: {risk_level}. Acesso fora do horario normal: {is_off_hours}."
    ),
}
LAYER_CHUNK = "Fonte: {source}\nCamada/documentacao: {domain}\n\n{chunk}"
PROJECT_CHUNK = "Fonte: {source}\nDocumentacao: {label}\n\n{chunk}"

# --- Fixed values: data dictionary -------------------------------------------------------

COLUMN_DESCRIPTIONS = {
    "silver": {
        "timestamp": "Data e hora do evento já convertida para tipo datetime. É a principal referência temporal do dataset.",
        "user_hash": "Identificador anonimizado do usuário, gerado com hash SHA-256 para atender LGPD.",
        "event": "Nome padronizado do evento realizado no log.",
        "resource": "Recurso associado ao evento, quando disponível.",
        "hour": "Hora do dia extraída do timestamp.",
        "day_of_week": "Dia da semana numérico extraído do timestamp. Exemplo: 0 = segunda-feira.",
        "is_weekend": "Indicador se o evento ocorreu em final de semana. 1 = sim, 0 = não.",
        "masked_ip": "Endereço IP com mascaramento parcial para atender requisitos de privacidade.",
        "errorcode": "Código de erro retornado pelo evento, quando existir.",
        "errormessage": "Mensagem de erro associada ao evento, quando existir.",
        "useragent": "Identificação do agente ou aplicação cliente que gerou o evento.",
        "requestparameters": "Parâmetros enviados na requisição original.",
        "responseelements": "Elementos retornados na resposta do evento.",
        "eventsource": "Serviço ou origem do evento no CloudTrail.",
    },
    "cost": {
        "timestamp": "Timestamp consolidado do agrupamento por minuto.",
        "date": "Data do agrupamento.",
        "hora_completa": "Hora amigável no formato HH:MM.",
        "service": "Serviço inferido a partir do nome do evento.",
        "requests": "Quantidade total de eventos no agrupamento.",
        "cost": "Custo estimado calculado com base em requests * UNIT_COST.",
    },
    "performance": {
        "timestamp": "Timestamp consolidado do agrupamento por minuto.",
        "date": "Data do agrupamento.",
        "hora_completa": "Hora amigável no formato HH:MM.",
        "requests": "Quantidade total de eventos no período.",
        "unique_users": "Quantidade de usuários distintos no período.",
    },
    "security": {
        "timestamp": "Timestamp consolidado do agrupamento por minuto.",
        "date": "Data do agrupamento.",
        "hora_completa": "Hora amigável no formato HH:MM.",
        "user_hash": "Identificador anonimizado do usuário.",
        "requests": "Quantidade de eventos daquele usuário no período.",
        "requests_zscore": "Pontuação estatística usada para identificar desvios no volume de requisições.",
        "is_off_hours": "Indica se o acesso ocorreu fora do horário considerado normal.",
        "risk_level": "Classificação simples de risco baseada no comportamento observado.",
    },
}
DEFAULT_DESCRIPTIONS = {
    "silver": "Coluna preservada pelo pipeline para uso analítico posterior.",
    "gold": "Coluna gerada automaticamente pelo pipeline.",
}
DATASET_PURPOSES = {
    "bronze": (
        "O processo **Bronze** tem como objetivo realizar a ingestão bruta do dataset original "
        "para o data lake, sem transformar, limpar ou descartar colunas."
    ),
    "silver": (
        "O processo **Silver** tem como objetivo transformar os dados brutos da camada Bronze "
        "em um dataset mais confiável, limpo, padronizado e pronto para análises posteriores."
    ),
    "cost": (
        "O dataset **Cost** serve para acompanhar o consumo operacional do ambiente. "
        "Ele mostra o volume de requisições por período e por serviço, além do custo estimado."
    ),
    "performance": (
        "O dataset **Performance** serve para acompanhar o comportamento de uso do sistema. "
        "Ele mostra volume de eventos e quantidade de usuários por período."
    ),
    "security": (
        "O dataset **Security** serve para apoiar análises de comportamento fora do padrão. "
        "Ele destaca uso por usuário, acessos fora de horário e uma classificação simples de risco."
    ),
}
DATASET_QUESTIONS = {
    "cost": [
        "Qual serviço gerou mais requisições em determinado período?",
        "Qual período teve maior custo estimado?",
        "Como o volume de eventos impacta o custo operacional?",
    ],
    "performance": [
        "Qual período teve maior volume de uso?",
        "Quantos usuários únicos utilizaram o sistema em cada período?",
        "Existem momentos de maior concentração de uso?",
    ],
    "security": [
        "Quais usuários apresentaram comportamento fora do padrão?",
        "Existem acessos fora de horário?",
        "Quais períodos tiveram maior risco estatístico?",
    ],
}
DOCUMENT_OUTLINE = [
    "# Documentação do Dataset {title}",
    "## 1. Para que serve\n\n{purpose}",
    "## 2. O que este dataset deve responder\n\n{questions}",
    "## 3. Informações gerais\n\n- **Quantidade de linhas:** {n_rows}\n- **Quantidade de colunas:** {n_columns}\n"
    "- **Data de geração:** {generated_at}{facts}",
    "## 4. Colunas geradas\n\n{columns}",
    "## 5. Descrição das colunas\n\n{descriptions}",
]
NO_QUESTIONS = "- Não há perguntas documentadas para este dataset."
