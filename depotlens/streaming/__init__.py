"""Optional stream-triggered intake (the reference itself is a daily batch)."""
