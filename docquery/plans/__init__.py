"""The declared model: what entities look like and how they are stored."""
