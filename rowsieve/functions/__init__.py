from rowsieve.functions.checks import RuleParameterError, register_rule
from rowsieve.functions.convert import leading_token, to_event_timestamp

__all__ = ["RuleParameterError", "leading_token", "register_rule", "to_event_timestamp"]
