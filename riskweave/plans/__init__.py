"""Domain plans: from input tables to marts, scores, alerts, evidence and context."""
