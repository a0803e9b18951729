"""Fixed values.

Everything in this file is a constant whose exact value decides results: line format, level and service
domains, thresholds, keyword lists, prompt texts and per-type settings.  They are stated plainly, in
natural order, and used from here only.
"""

# Line format (anchored; Unicode word characters) and timestamp text.
LOG_LINE_PATTERN = r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) (\w+) \[(\w+)\] (.+)"

# Domains used for zero filling.
LEVELS = ["DEBUG", "INFO", "WARN", "ERROR", "CRITICAL"]
ERROR_LEVELS = ["ERROR", "CRITICAL"]
SERVICES = [
    "ordersvc", "paymentsvc", "usersvc", "inventorysvc", "notificationsvc", "analyticsvc",
    "authsvc", "gateway", "apigateway", "websocket", "scheduler", "worker",
]

# Window defaults.
WINDOW_DEFAULTS = {"max_tokens": 5000, "overlap_ratio": 0.15, "min_tokens": 100, "encoding": "cl100k_base"}
SIMPLE_CHARS_PER_TOKEN = 4
LINE_SPLIT_TOKENS = 1000

# Words whose lines the cleaning stage drops.
NOISE_WORDS = ["healthz", "readinessProbe", "livenessProbe"]
LEGACY_NOISE_WORDS = ["healthz", "readinessProbe"]

# Monitor and automatic trigger limits.
MONITOR_THRESHOLDS = {
    "error_rate": 0.1, "critical_count": 5, "service_errors": 5, "analysis_trigger": 20,
    "analysis_interval_seconds": 30, "analysis_rows": 50, "buffer_rows": 1000,
}
AUTO_THRESHOLDS = {
    "min_logs": 20, "max_logs": 100, "error_rate": 0.15, "critical_count": 3, "warning_count": 10,
    "service_errors": 5, "history_rows": 100,
}

# Reports.
TOP_SERVICES = 3
RESULT_FILES_SHOWN = 10
DASHBOARD_TAIL_LINES = 50
RESULT_FILE_PREFIXES = ["analysis_results", "auto_analysis", "monitor_analysis"]

# Text used where a meta field is missing, and the model name of request bodies.
UNKNOWN = "[unknown]"
MODEL_NAME = "Qwen/Qwen2.5-7B-Instruct"

# Analysis types in detection order with their keywords; "general" is the fallback.
TYPE_KEYWORDS = {
    "database": ["database", "db", "mysql", "postgresql", "connection", "query", "sql"],
    "memory": ["memory", "oom", "outofmemory", "gc", "heap", "ram"],
    "network": ["network", "timeout", "connection refused", "unreachable", "latency"],
    "security": ["security", "attack", "breach", "unauthorized", "injection", "hack"],
    "performance": ["performance", "slow", "bottleneck", "cpu", "response time"],
    "critical": ["critical", "fatal", "emergency", "down", "unavailable"],
}
GENERAL = "general"

# Settings per analysis type (temperature, max_tokens, timeout).
TYPE_SETTINGS = {
    "general": (0.2, 1200, 60),
    "database": (0.1, 1500, 90),
    "memory": (0.1, 1400, 90),
    "network": (0.2, 1300, 75),
    "security": (0.1, 1600, 120),
    "performance": (0.2, 1400, 90),
    "critical": (0.1, 1800, 150),
}

# System prompts per analysis type.
SYSTEM_PROMPTS = {
    "general": (
        "You are an SRE/DevOps log expert. Be factual and concise. "
        "Analyze the provided logs and provide actionable insights. "
        "Focus on identifying root causes and providing concrete solutions. "
        "Keep answers structured and easy to follow."
    ),
    "database": (
        "You are a database and infrastructure expert specializing in database performance and reliability. "
        "Analyze database-related logs to identify connection issues, performance problems, and data integrity concerns. "
        "Provide specific database tuning recommendations and monitoring commands. "
        "Consider both immediate fixes and long-term optimizations."
    ),
    "memory": (
        "You are a system performance expert specializing in memory management and resource optimization. "
        "Analyze memory-related logs to identify leaks, allocation issues, and resource constraints. "
        "Provide specific memory tuning recommendations and monitoring strategies. "
        "Consider both application-level and system-level memory management."
    ),
    "network": (
        "You are a network infrastructure expert specializing in connectivity and performance issues. "
        "Analyze network-related logs to identify connectivity problems, latency issues, and protocol errors. "
        "Provide specific network troubleshooting steps and optimization recommendations. "
        "Consider both local network and external service connectivity."
    ),
    "security": (
        "You are a cybersecurity expert specializing in threat detection and incident response. "
        "Analyze security-related logs to identify potential threats, attacks, and vulnerabilities. "
        "Provide specific security recommendations and incident response procedures. "
        "Prioritize immediate security actions and long-term security improvements."
    ),
    "performance": (
        "You are a performance engineering expert specializing in system optimization and scalability. "
        "Analyze performance-related logs to identify bottlenecks, resource constraints, and optimization opportunities. "
        "Provide specific performance tuning recommendations and monitoring strategies. "
        "Consider both immediate performance fixes and architectural improvements."
    ),
    "critical": (
        "You are an emergency response expert specializing in critical system failures and incident management. "
        "Analyze critical logs to identify immediate threats to system availability and data integrity. "
        "Provide urgent response procedures and immediate mitigation steps. "
        "Prioritize system recovery and data protection above all else."
    ),
}

# Task block that closes the user prompt of each analysis type.
TASK_BLOCKS = {
    "general": (
        "[TASK]\n"
        "1) 핵심 증상 3~5개\n"
        "2) 원인 가설(우선순위)\n"
        "3) 즉시 점검 명령(쉘)\n"
        "4) 재발방지 액션\n"
        "5) 확신도[낮음/중간/높음]"
    ),
    "database": (
        "[DATABASE ANALYSIS TASK]\n"
        "1) 데이터베이스 연결 상태 및 오류\n"
        "2) 쿼리 성능 및 타임아웃 이슈\n"
        "3) 연결 풀 및 리소스 사용량\n"
        "4) 데이터베이스 서버 상태 점검 명령\n"
        "5) 성능 최적화 및 모니터링 권장사항\n"
        "6) 확신도[낮음/중간/높음]"
    ),
    "memory": (
        "[MEMORY ANALYSIS TASK]\n"
        "1) 메모리 사용량 패턴 및 누수 증상\n"
        "2) OutOfMemoryError 및 메모리 부족 원인\n"
        "3) GC 압력 및 메모리 할당 이슈\n"
        "4) 메모리 상태 점검 명령\n"
        "5) 메모리 최적화 및 모니터링 권장사항\n"
        "6) 확신도[낮음/중간/높음]"
    ),
    "network": (
        "[NETWORK ANALYSIS TASK]\n"
        "1) 네트워크 연결 상태 및 타임아웃\n"
        "2) 지연시간 및 패킷 손실 이슈\n"
        "3) 외부 서비스 연결 문제\n"
        "4) 네트워크 상태 점검 명령\n"
        "5) 네트워크 최적화 및 모니터링 권장사항\n"
        "6) 확신도[낮음/중간/높음]"
    ),
    "security": (
        "[SECURITY ANALYSIS TASK]\n"
        "1) 보안 위협 및 공격 시도\n"
        "2) 인증/인가 실패 및 권한 문제\n"
        "3) 의심스러운 활동 패턴\n"
        "4) 보안 상태 점검 명령\n"
        "5) 보안 강화 및 모니터링 권장사항\n"
        "6) 확신도[낮음/중간/높음]"
    ),
    "performance": (
        "[PERFORMANCE ANALYSIS TASK]\n"
        "1) 성능 병목 및 응답 시간 이슈\n"
        "2) 리소스 사용량 및 제약사항\n"
        "3) 처리량 및 동시성 문제\n"
        "4) 성능 상태 점검 명령\n"
        "5) 성능 최적화 및 모니터링 권장사항\n"
        "6) 확신도[낮음/중간/높음]"
    ),
    "critical": (
        "[CRITICAL INCIDENT ANALYSIS TASK]\n"
        "1) 즉시 위험 요소 및 시스템 다운 증상\n"
        "2) 데이터 손실 위험 및 무결성 문제\n"
        "3) 서비스 중단 원인 및 영향 범위\n"
        "4) 긴급 복구 및 점검 명령\n"
        "5) 즉시 조치사항 및 장기 개선방안\n"
        "6) 확신도[낮음/중간/높음]"
    ),
}

# System prompt and user text of the one-prompt analysis of a row selection.
SELECTION_SYSTEM_PROMPT = (
    "You are an SRE/DevOps log expert. Analyze the logs and provide: (1) key symptoms, "
    "(2) root-cause hypotheses with priority, (3) concrete shell commands to verify, "
    "(4) mitigations/preventions, (5) confidence level. Keep answers concise but actionable."
)
SELECTION_USER_PREFIX = "Analyze these logs:\n\n"

# Display units of the elapsed-time text (seconds, minutes, hours ago).
TIME_AGO_UNITS = ("초 전", "분 전", "시간 전")

# Alert texts (error rate in percent with one digit; critical lines; errors of a service).
ALERT_ERROR_RATE = "🚨 높은 에러율: %s%%"
ALERT_CRITICAL = "🚨 크리티컬 로그 다수: %d개"
ALERT_SERVICE = "🚨 %s 서비스 에러 다수: %d개"
